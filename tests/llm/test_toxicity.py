import math
from collections import Counter

import numpy as np
import pytest

from wakeline.llm import toxicity
from wakeline.llm.registry import op8_toxicity

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet").select("doc_id", "toxic")
    rows = op8_toxicity(spark, SF).join(labels, "doc_id").where("held_out").collect()
    toxic = [r for r in rows if r.toxic == 1]
    assert len(toxic) > 50
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in rows if r.toxic == 0) <= 0.01 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)


def test_odd_rows_and_missing_labels(spark, odd_docs, no_docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(odd_docs, none) == 0.0
    assert [r.predicted for r in toxicity.score(odd_docs, 0.0).collect()] == [0] * odd_docs.count()
    docs = spark.createDataFrame([(k, f"w{k // 2 % 40} {'idiot' if k % 2 else 'friend'} number {k} said {k * 7} words") for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, 1, k % 2) for k in range(400)] + [(1, 1, 1), (None, 1, 1), (3, 1, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    out = toxicity.score(odd_docs, model)
    assert out.columns == [*odd_docs.columns, "score", "predicted"]
    rows = {r.doc_id: r for r in out.collect()}
    assert rows[3].score == rows[4].score == rows[5].score
    assert toxicity.score(no_docs, model).count() == 0
    right = toxicity.score(docs, model).collect()
    assert sum(r.predicted == r.doc_id % 2 for r in right) > 390


def plain_ratios(train, corpus, words):
    """Log ratios of each word by dictionaries: passages above, different words before it below, the corpus below that."""
    passages = {y: set() for y in (0, 1)}
    for t, y in train:
        w = [toxicity.START] * 3 + toxicity.words_of(t) + [toxicity.START] * 2
        passages[y] |= {tuple(w[k - 3 : k + 3]) for k in range(3, len(w) - 2)}
    count = {y: Counter((p[2], p[3]) for p in passages[y]) for y in passages}
    vocabulary = {x for y in count for pair in count[y] for x in pair}
    pairs = {p for t in corpus for w in [toxicity.words_of(t)] for p in zip([toxicity.START, *w[:-1]], w)}
    company = Counter(w for _, w in pairs if w in vocabulary)
    total = sum(company.values()) + len(vocabulary) + 1
    kept = {y: Counter(w for _, w in count[y]) for y in count}
    lost = sum(min(n, toxicity.DISCOUNT) for y in kept for n in kept[y].values()) / sum(sum(kept[y].values()) for y in kept)
    of = {y: Counter() for y in count}
    cut = Counter()
    for y in count:
        for (v, _), n in count[y].items():
            of[y][v] += n
            cut[v] += min(n, toxicity.TOP_DISCOUNT)

    def p(y, v, w):
        base = (company[w] + 1) / total if w in vocabulary else 1 / total
        low = max(kept[y][w] - toxicity.DISCOUNT, 0) / sum(kept[y].values()) + lost * base
        c = of[0][v] + of[1][v]
        return max(count[y][v, w] - toxicity.TOP_DISCOUNT, 0) / max(of[y][v], 1) + (cut[v] / c if c else 1) * low

    return [math.log(p(1, v, w) / p(0, v, w)) for v, w in zip([toxicity.START, *words[:-1]], words)]


def test_ratios_equal_plain_kneser_ney(spark):
    rnd = np.random.default_rng(1)
    some = [f"w{k}" for k in range(30)]
    texts = [" ".join(rnd.choice(some, 12)) + (" you utter fool" if k % 2 else "") for k in range(200)] + ["", None]
    texts[4] = texts[2]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = [(k, k % 2) for k in range(160)]
    model = toxicity.fit(docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    fold = {r.doc_id: r.f for r in docs.select("doc_id", toxicity.fold("doc_id").alias("f")).collect()}
    train = [(texts[k], y) for k, y in labels if 0 < fold[k] < toxicity.FOLDS - 1]
    for text in (texts[3], texts[4], "you utter fool", "never seen words and w3 w4 utter fool"):
        words = toxicity.words_of(text)
        assert model.ratios(words) == pytest.approx(plain_ratios(train, texts, words))
    # an expression that always follows one word tells
    assert model.ratios(["you", "utter", "fool"])[2] > 2


def test_bigrams_are_held_in_parts(monkeypatch):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"_text": ["a b c a b c a b c", "", None, "c b a"], "_label": [0, 1, 1, 1]})
    met = []
    for held in (10**6, 2, 1):
        monkeypatch.setattr(toxicity, "HELD", held)
        bits = {}
        for part in toxicity._bigrams(iter([batch, batch])):
            assert part.num_rows <= held
            for v, w, p, b in zip(*part.to_pydict().values(), strict=True):
                bits[v, w, p] = bits.get((v, w, p), 0) | b
        met.append(bits)
    assert met[0] == met[1] == met[2] and len(met[0]) > 8
    assert not list(toxicity._bigrams(iter([])))


def test_numbers_that_rise_are_packed_and_read_again():

    rng = np.random.default_rng(1)
    for top in (1, 127, 128, 1 << 14, 1 << 35, 1 << 56):
        x = np.unique(rng.integers(0, top, 500))
        assert (toxicity._unpacked(toxicity._packed(x)) == x).all()
    assert (toxicity._unpacked(toxicity._packed(np.array([0]))) == [0]).all()


@pytest.mark.parametrize("most", [7, 3 << 20])
def test_company_counts_different_words_before(spark, monkeypatch, most):
    monkeypatch.setattr(toxicity, "PAIRS", most)
    texts = ["a b a c a b", "c a b b", "", None, "x a", "a " * 50] + [f"w{k} b w{k % 3} a" for k in range(40)]
    words = ["a", "b", "c", "never"]
    before = {w: set() for w in words}
    for t in texts:
        row = toxicity.words_of(t)
        for v, w in zip([toxicity.START, *row], row):
            if w in before:
                before[w].add(v)
    df = spark.createDataFrame([(t,) for t in texts], "_text string").repartition(3)
    assert toxicity.company(df, words).tolist() == [len(before[w]) for w in words]
    assert toxicity.company(df.limit(0), words).tolist() == [0, 0, 0, 0]


def test_a_passage_of_both_classes_tells_little(spark):
    """Twelve toxic and eight ordinary texts have one passage, at the discount's edge; slurs come without it."""
    some = [f"w{k}" for k in range(30)]
    rnd = np.random.default_rng(2)
    texts, labels = [], []
    fold = {r.id: r.f for r in spark.range(3000).select("id", toxicity.fold("id").alias("f")).collect()}
    left = {0: 8, 1: 12}
    for k in range(3000):
        w, toxic = list(rnd.choice(some, 12)), int(k % 10 == 0)
        if 0 < fold[k] < toxicity.FOLDS - 1 and left[toxic]:
            left[toxic] -= 1
            w[6:6] = ["passage", "of", "both"]
        elif fold[k] == toxicity.FOLDS - 1 and k % 7 == 1 and not toxic:
            w[6:6] = ["passage", "of", "both"]
        if toxic:
            w[3:3] = ["slur"]
        texts.append((k, " ".join(w)))
        labels.append((k, toxic))
    model = toxicity.fit(spark.createDataFrame(texts, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    words = "w1 passage of both w2 slur w3".split()
    assert model.ratios(words)[2] > 3 > 1 > model.evidence(words)[2] > 0
    assert model.evidence(words)[5] == pytest.approx(model.ratios(words)[5]) and model.evidence(words)[5] > 1
    got = [(labels[k][1], model.score(t)) for k, t in texts if fold[k] == 0]
    assert all((s >= 0.5) == y for y, s in got)
    assert model.score("w1 w2 w3 passage of both w4 w5") < 0.5 < model.score("w1 w2 w3 slur w4 w5")


def made_model(words):
    """A model of sorted digests with random evidence; every tenth pair of neighbours is a bigram."""
    rnd = np.random.default_rng(7)
    digests = np.unique(np.array([toxicity._digest(w) for w in [toxicity.START, *words]], np.uint64))
    n = len(digests)
    keys = np.unique(rnd.integers(0, n, n) * (n + 1) + rnd.integers(0, n, n))
    odds = lambda k: rnd.normal(0, 3, k)
    uni, seen = rnd.uniform(0.01, 1, (2, n + 1)), rnd.uniform(0, 0.5, (2, len(keys)))
    return toxicity.Model(digests, uni, rnd.uniform(0.1, 1, n + 1), keys, seen, np.array([0.1, 1, -1, 0.5]), np.append(odds(n), 0), odds(len(keys)))


@pytest.mark.parametrize("run", [1, 40, 1 << 16])
def test_texts_of_a_run_are_scored_as_each_by_itself(monkeypatch, run):
    """Whole, window and pair as plain forms over each text's evidence, whatever texts stand beside it, and few words held."""
    monkeypatch.setattr(toxicity, "RUN", run)
    monkeypatch.setattr(toxicity, "HELD", 10)
    rnd = np.random.default_rng(8)
    some = [f"w{k}" for k in range(40)]
    model = made_model(some[:30])
    texts = [" ".join(rnd.choice(some, n)) for n in (1, 2, 3, 31, 32, 33, 90)] + [None, "", " .", "w1", "w1 w1", "never seen", *[" ".join(rnd.choice(some, 50)) for _ in range(20)], None]
    got = model.features_of(texts)
    for text, f in zip(texts, got, strict=True):
        r = model.evidence(toxicity.words_of(text))
        windows = [r[k : k + toxicity.WINDOW].sum() for k in range(max(1, len(r) - toxicity.WINDOW + 1))]
        want = (r.mean(), max(windows) / toxicity.WINDOW, np.sort(r)[-toxicity.PAIR :].sum() / toxicity.PAIR) if len(r) else (0, 0, 0)
        assert f == pytest.approx(want, abs=1e-8) and model.features(text) == tuple(f)
    assert model.scores(texts).tolist() == [model.score(t) for t in texts] and model.features_of([]).shape == (0, 3)
    words = some[:30]
    r = np.array([model.ratios([v, w])[1] for v in words for w in words])
    assert len(np.unique(r.round(9))) > len(words)


def test_what_is_sent_to_workers_does_not_grow_with_the_length_of_words():
    import pickle

    short, long = (made_model([f"{k}" + "x" * size for k in range(500)]) for size in (1, 1000))
    assert abs(len(pickle.dumps(short)) - len(pickle.dumps(long))) < 2000
    numbers = toxicity._Numbers(long.words)
    for k in range(3 * toxicity.HELD // 1000):
        numbers.of([f"{k} {j}" for j in range(1000)])
        assert len(numbers) <= toxicity.HELD + 1000 == 101_000


def test_scored_rows_are_passed_on_in_parts(spark):
    import pyarrow as pa

    batch = pa.RecordBatch.from_pydict({"k": list(range(2 * toxicity.PART + 3))})
    parts = list(toxicity._in_parts(batch))
    assert [p.num_rows for p in parts] == [toxicity.PART, toxicity.PART, 3] and pa.Table.from_batches(parts) == pa.Table.from_batches([batch])
    assert not list(toxicity._in_parts(batch.slice(0, 0)))
    df = spark.range(5 * toxicity.PART + 1).selectExpr("id as doc_id", "concat('w', id) as text").coalesce(1)
    rows = toxicity.score(df, made_model(["w1", "w2"])).collect()
    assert [(r.doc_id, r.text) for r in rows] == [(k, f"w{k}") for k in range(5 * toxicity.PART + 1)]
