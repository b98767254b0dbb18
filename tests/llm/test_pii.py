import hashlib
import re

from wakeline.llm import pii
from wakeline.llm.registry import op5_pii

SF = "/root/testdata/sf0.01"
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(d))) % 10 == 0


def plain(text):
    out = {}
    for kind, p in PLAIN.items():
        out[kind] = []
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m[0])
            ok = {"email": True, "ip": kind == "ip" and all(int(x) <= 255 for x in m[0].split(".")), "card": 13 <= len(d) <= 19 and luhn(d), "phone": 9 <= len(d) <= 15}[kind]
            if ok:
                out[kind].append(m.span())
    return out


def check(rows, texts):
    for r in rows:
        want = plain(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [len(want[k]) for k in pii.KINDS], (r, want)
        base = [f"{k}:{a}:{b}" for k in pii.KINDS for a, b in want[k]]
        assert r.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
        assert set(base) <= set(r.spans.split(","))


def test_query_base_equals_brute_force(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = op5_pii(spark, SF).collect()
    assert len(rows) == len(texts)
    check(rows, texts)
    # every assigned key of the corpus is found by its context, and nothing but keys
    keys = {k: re.findall(r'token = "([0-9a-f]{40})"', t or "") for k, t in texts.items()}
    assert sum(map(len, keys.values())) >= 8
    for r in rows:
        found = [s.split(":") for s in r.spans.split(",") if s.startswith("secret:")]
        assert [texts[r.doc_id][int(a) : int(b)] for _, a, b in found] == keys[r.doc_id]
        assert r.n_found == len(found) and r.n_spans == len([s for s in r.spans.split(",") if s])


def test_secrets_are_learnt_from_seeds(spark):
    seeds = [(k, f'w{k} set secret_key = "{hashlib.sha1(str(k).encode()).hexdigest()}" here') for k in range(12)]
    rows = seeds + [(100, "x secret_key = Zm9vYmFyMTIzNDU2Nzg5 y"), (101, "the build Zm9vYmFyMTIzNDU2Nzg5 is done"), (102, "set secret_key = value1 now"), (103, f"commit {hashlib.sha1(b'z').hexdigest()} fixes it")]
    got = {r.doc_id: r.found for r in pii.find(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    texts = dict(rows)
    assert [[texts[k][s.start : s.end] for s in got[k]] for k in (0, 100, 101, 102, 103)] == [[hashlib.sha1(b"0").hexdigest()], ["Zm9vYmFyMTIzNDU2Nzg5"], [], [], []]
    assert {s.kind for f in got.values() for s in f} == {"secret"}


def test_odd_texts(spark, odd_docs, no_docs):
    texts = [
        "a@b.com_x@y.org a@b a.b+c%d@e-f.g.h. @x.y 🙂é@b.c q@w.e@r.t", "1.2.3.4.5.6.7.8 256.1.1.1 0001.2.3.4 1..2.3.4 1.2.3", "4111 1111 1111 1111 4111-1111-1111-1112 41111111111111111111111",
        "x" * 20_000 + "@", "1 " * 30_000, "a." * 20_000 + "@b" + ".c" * 20_000, "+1 (555) 123-4567 +12 3 +1-2-3-4-5-6-7-8-9-0-1-2-3-4-5-6", "\x02a@b.c\x02 1.1.1.1\x02", "", None, "9" * 5_000, "4111 1111 1111 1111 5.6.7.8",
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    check(pii.digest(pii.find(df)).collect(), dict(enumerate(texts)))
    assert pii.find(odd_docs).count() == odd_docs.count() and pii.find(no_docs).count() == 0
    assert pii.redact(odd_docs).count() == odd_docs.count()


def test_contexts_find_what_the_patterns_miss(spark):
    rows = [(k, f"note {k} my card number 41111111111111{k:02d} ok") for k in range(60)]
    seeds = {k for k, t in rows if plain(t)["card"]}
    assert len(seeds) >= 5
    rows = [r for r in rows if r[0] in seeds] + [(100, "so my card number 4111111111111199, fine"), (101, "there were 4111111111111199 of them"), (102, "my card number was lost 12 times")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.found for r in pii.find(df).collect()}
    t = dict(rows)[100]
    assert [(s.kind, t[s.start : s.end]) for s in got[100]] == [("card", "4111111111111199")]
    assert not any(got[k] for k in got if k != 100)
    assert {r.doc_id: r.text for r in pii.redact(df).collect()}[100] == "so my card number [card], fine"


def test_contexts_of_numbers_with_spaces(spark):
    seeds = [(k, f"v{k} please call me +1 ({100 + k}) 555-{1000 + k} today") for k in range(12)]
    cards = [f"411111111111{k:04d}" for k in range(200)]
    cards = [f"{c[:4]} {c[4:8]} {c[8:12]} {c[12:]}" for c in cards if luhn(c)]
    seeds += [(50 + k, f"so pay by {c} now") for k, c in enumerate(cards)]
    want = {
        200: ("oh call me 555 123 4567, thanks", "phone", "555 123 4567"), 201: ("oh call me (555) 123-4567.", "phone", "(555) 123-4567"), 202: ("or call me 0171-5557713 first", "phone", "0171-5557713"),
        203: ("we pay by 4111 1111 1111 1199 then", "card", "4111 1111 1111 1199"), 204: ("we pay by 4111111111111199 12 times", "card", "4111111111111199"), 205: ("I pay by 4111-1111-1111-1199", "card", "4111-1111-1111-1199"),
    }
    none = [(300, "there are 555 123 4567 of them"), (301, "call me 12 times, pay by 4 or 5"), (302, "call me at 10.0.0.1 10.0.0.2")]
    df = spark.createDataFrame(seeds + [(k, t) for k, (t, _, _) in want.items()] + none, "doc_id long, text string")
    got = {r.doc_id: r.found for r in pii.find(df).collect()}
    assert {k: [(s.kind, t[s.start : s.end]) for s in got[k]] for k, (t, _, _) in want.items()} == {k: [(kind, x)] for k, (_, kind, x) in want.items()}
    assert not any(got[k] for k in got if k not in want)


def test_values_are_whole_numbers(spark):
    df = spark.createDataFrame([(1, "call me +1 (017) 555-7713"), (2, "pay by 4111 1111 1111 1111"), (3, "call me 1 017 555 7713"), (4, "see 192.168.100.200 10 a@b.c")], "_id long, _text string")
    base = pii.base_spans(df.selectExpr("*", "_id as _h"), "_text")
    assert sorted({(r["_id"], r.value, r.kind) for r in pii._token_rows(base).collect()}) == [(1, "10175557713", "phone"), (2, "4111111111111111", "card"), (3, "10175557713", None), (4, "192.168.100.200", "ip")]
