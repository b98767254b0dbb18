"""Line dedup, mixing, sharding and quality rules."""

import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tests.oracle import differences, duck
from wakeline.llm import bpe, line_dedup, mixing, pii, quality, registry, sharding, simhash, suffix_dedup, toxicity
from wakeline.session import shared_folder

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_sql_gives_the_same_rows(spark, name):
    assert differences(registry.QUERIES[name](spark, SF), duck(SF), registry.ORACLE_SQL[name]) == ""


def test_boilerplate_lines(spark):
    rows = [(k, "h", f"menu\nown {k}\n\nmenu") for k in range(8)] + [(k, "h", f"own {k}") for k in range(8, 40)] + [(50, None, "menu"), (51, "h", None), (52, "h", ""), (53, "small", "menu")]
    df = spark.createDataFrame(rows, "page_id long, host string, text string")
    got = {r.page_id: r for r in line_dedup.drop_boilerplate(df, "host").collect()}
    assert len(got) == len(rows)
    assert got[3].text == "own 3\n" and (got[3].n_lines, got[3].n_dropped) == (3, 2)
    assert got[50].text == "menu" and got[51].text is None and got[52].text == "" and got[53].text == "menu"
    assert line_dedup.drop_boilerplate(df.limit(0), "host").count() == 0


def test_odd_documents(odd_docs, no_docs):
    out = line_dedup.drop_boilerplate(odd_docs, "source")
    assert out.columns == [*odd_docs.columns, "n_lines", "n_dropped"] and out.count() == odd_docs.count()
    assert quality.judge(odd_docs).count() == odd_docs.count() and quality.judge(no_docs).count() == 0
    placed = sharding.place(odd_docs, "doc_id")
    assert placed.count() == odd_docs.count() and placed.where("shard is null").count() == 0
    assert placed.select("doc_id", "shard").distinct().where("doc_id = 2").count() == 1
    mixed = mixing.mix(odd_docs)
    assert mixed.count() == odd_docs.count() and mixing.mix(no_docs).count() == 0 and mixing.take(no_docs).count() == 0
    assert mixed.where("size = 0 and copies > 0").count() == 0


def test_shards_take_turns():
    shards = ("a", "b", "c", "d", "e")
    owner = sharding.fill(shards, 101)
    assert sorted(Counter(owner).values()) == [20, 20, 20, 20, 21]
    # by preference lists written out
    digest = lambda s: int(hashlib.md5(s.encode()).hexdigest()[:15], 16)
    lists = [[(digest(f"offset:{s}") + j * (digest(f"skip:{s}") % 100 + 1)) % 101 for j in range(101)] for s in shards]
    want = {}
    for turn in range(101):
        k = turn % 5
        want[next(s for s in lists[k] if s not in want)] = k
    assert owner == [want[s] for s in range(101)]
    less = sharding.fill(shards[:-1], 101)
    assert sum(a != b for a, b in zip(owner, less, strict=True) if a != 4) < 20


@pytest.mark.parametrize("sizes", [{"a": 100, "b": 7, "c": 30, "d": 1000, None: 4, "e": 0}, {"": 0}, {f"host{k * 7919 % 2000:04}": k * k % 997 for k in range(2000)}])
def test_targets_fill_by_weight_under_the_cap(spark, sizes):
    df = spark.createDataFrame([(k, v) for k, v in sizes.items()], "source string, size long")
    got = {r._source: r.target for r in mixing.targets(df).collect()}
    order = sorted(k for k in sizes if k is not None) + [None] * (None in sizes)
    weight = {k: (1, 2, 3)[i % 3] for i, k in enumerate(order)}
    want, left, open_ = {}, float(sum(sizes.values())), set(order)
    while open_:
        level = left / sum(weight[k] for k in open_)
        over = {k for k in open_ if level * weight[k] >= 3 * sizes[k]}
        for k in over or open_:
            want[k] = float(min(3 * sizes[k], level * weight[k]))
        if not over:
            break
        left -= sum(3 * sizes[k] for k in over)
        open_ -= over
    assert got == pytest.approx(want)


def test_mix_meets_its_targets(spark):
    df = registry.op7_mixing(spark, "/root/testdata/sf0.01")
    rows = df.collect()
    sources = {r.doc_id: r.source for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    taken, target, largest = Counter(), {}, defaultdict(int)
    for r in rows:
        s = sources[r.doc_id]
        taken[s] += r.taken
        target[s] = r.target
        largest[s] = max(largest[s], r.size)
        assert r.taken <= 3 * r.size and r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    for s, t in target.items():
        assert abs(taken[s] - t) <= largest[s] + 1e-6 * t
    assert sorted(map(tuple, registry.op7_mixing(spark, "/root/testdata/sf0.01").collect())) == sorted(map(tuple, rows))


def test_taken_rows_repeat(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = mixing.mix(docs).agg(F.sum("copies")).first()[0]
    out = mixing.take(docs)
    assert out.columns == docs.columns and out.count() == want


def test_equal_rows_of_a_source_share_its_target(spark):
    """One of two sources is 300 equal rows; the other is long enough for the first to be cut in half."""
    text = " ".join(["word"] * 10)
    rows = [(1, text, "a")] * 300 + [(k, " ".join(f"x{j}" for j in range(30)), "b") for k in range(2, 52)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = mixing.mix(df).collect()
    assert len(got) == len(rows)
    for s in ("a", "b"):
        mine = [r for r in got if (r.doc_id == 1) == (s == "a")]
        assert abs(sum(r.size * r.copies for r in mine) - mine[0].target) <= mine[0].size
    assert {r.copies for r in got if r.doc_id == 1} == {0, 1}
    assert mixing.take(df).where("source = 'a'").count() == sum(r.copies for r in got if r.doc_id == 1)


def plain_fold(items):
    """Pivotal rounding of (id, size, open part, random number) one after another."""
    out, still = {}, None
    for b in items:
        if still is None:
            still = b
            continue
        (ia, sa, pa, ua), (ib, sb, pb, ub) = still, b
        ma, mb = pa * sa, pb * sb
        up, down = min(sa - ma, mb), min(ma, sb - mb)
        if ub * (up + down) < down:
            if sa - ma <= mb:
                out[ia], still = 1, (ib, sb, (mb - (sa - ma)) / sb, ub)
            else:
                out[ib], still = 0, (ia, sa, (ma + mb) / sa, ua)
        elif ma <= sb - mb:
            out[ia], still = 0, (ib, sb, (mb + ma) / sb, ub)
        else:
            out[ib], still = 1, (ia, sa, (ma - (sb - mb)) / sa, ua)
    return out, still


def test_fold_equals_the_plain_one(spark):
    rnd = __import__("random").Random(8)
    items = [(k, float(rnd.randint(1, 50)), rnd.choice([0.25, 0.5, 0.75]), round(rnd.random(), 6)) for k in range(60)]
    rows = spark.createDataFrame([("s", 0, (k, k), size, p, u) for k, size, p, u in items], "_source string, _block long, _id struct<id:long,t:long>, _size double, _p double, _u double")
    state = mixing._settle_blocks(rows).first()
    out, still = plain_fold(sorted(items, key=lambda x: x[3]))
    assert {d["_id"]["id"]: d["_more"] for d in state["_done"]} == out
    assert state["_open"]["_id"]["id"] == still[0] and state["_open"]["_p"] == pytest.approx(still[2])


NAMES = ["_host", "_lines", "_key", "_i", "_k", "_s", "_text", "_own", "_id", "_h", "_words", "row", "n", "size", "target", "copies", "fp", "component", "_n", "_t", "_label", "score", "slot", "shard", "n_words", "kept", "found", "token_ids", "spans", "start", "node", "corners"]


def test_clashing_names(spark):
    """Columns named like those used inside an operator stay as they are, or give way where the docstring says so."""
    rows = [(k, f"line {k}\nthe same words of all for the ip 1.2.3.{k}", "s", *["x"] * len(NAMES)) for k in range(6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, " + ", ".join(f"{c} string" for c in NAMES))
    kept = [c for c in df.columns if c not in ("doc_id", "text", "source", "n_words", "kept", "slot", "shard", "score", "token_ids")]
    labels = df.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic")
    results = {
        "line": line_dedup.drop_boilerplate(df, "source"), "take": mixing.take(df), "redact": pii.redact(df), "judge": quality.judge(df), "first": simhash.keep_first(df),
        "place": sharding.place(df, "doc_id"), "score": toxicity.score(df, toxicity.fit(df, labels)), "encode": bpe.encode(df, registry.vocabulary()),
    }
    for name, out in results.items():
        got = out.select(kept).distinct().collect()
        assert [tuple(r) for r in got] == [("x",) * len(kept)], name
    assert pii.find(df).count() == simhash.near_duplicates(df).count() == mixing.mix(df).count() == suffix_dedup.deduplicate(df).count() == 6
    assert "[ip]" in results["redact"].first().text


def test_rows_of_one_id_and_different_texts(spark):
    df = spark.createDataFrame([(1, "call 10.0.0.1 now a@b.org"), (1, "nothing here but z@y.org"), (1, "plain and clean words"), (None, "x 10.0.0.2"), (None, "clean")], "doc_id long, text string")
    assert sorted(r.text for r in pii.redact(df).collect()) == ["call [ip] now [email]", "clean", "nothing here but [email]", "plain and clean words", "x [ip]"]


def test_shards_are_written_apart(spark):
    path = f"{shared_folder(spark)}/shards-{id(spark)}"
    df = spark.range(1000).withColumnRenamed("id", "doc_id")
    sharding.write(df, path, "doc_id", shards=("a", "b", "c"))
    back = spark.read.parquet(path)
    assert back.count() == 1000 and back.select("shard").distinct().count() == 3
    assert back.select("doc_id", "shard").exceptAll(sharding.place(df, "doc_id", shards=("a", "b", "c")).select("doc_id", "shard")).count() == 0


def test_taken_rows_keep_their_other_columns_and_texts_are_not_written(spark, monkeypatch):
    rows = [(k // 3, f"words of text {k // 3} " * (1 + k // 3 % 4), f"s{k // 3 % 2}", None if k % 3 == 2 else {"a": k % 2}) for k in range(90)]
    rows += [(None, None, None, None)] * 2 + [(1000, "one text that stands here often", "s1", {"a": 1})] * 40
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, tags map<string,int>")
    written = []
    monkeypatch.setattr(mixing, "settle", lambda x, f=mixing.settle: written.append(x.columns) or f(x))
    out = mixing.take(df)
    assert out.schema == df.schema
    assert written and not any({"row", "text"} & set(c) for c in written)
    want = {}
    for r in mixing.mix(df).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.copies
    got = out.collect()
    count = {}
    for r in got:
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    assert count == {k: n for k, n in want.items() if n}
    known = {(a, b, c, str(d)) for a, b, c, d in rows}
    assert {(r[0], r[1], r[2], str(r[3])) for r in got} <= known
