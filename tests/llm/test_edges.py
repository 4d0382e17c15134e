"""Nulls, empty tables, repeated rows, long texts and clashing columns, for every operator."""

import collections

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import boost, chat, collide, hamming, jaccard, labelled, mix, pack, passages, quality, scratch, shards, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that operators use inside.
CLASH = ["row", "key", "size", "token", "hash", "_row", "_key", "_cuts", "_copies", "copies", "cuts", "times", "part", "query", "toxicity", "KEY", "n", "count", "score", "features"]


def sentence(rng, n):
    return " ".join(f"w{rng.integers(0, 5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def odd(spark):
    """Null ids, texts and sources, empty and very long texts, repeated rows and ids, and columns with clashing names."""
    rng = np.random.default_rng(11)
    text = sentence(rng, 90)
    rows = [(1, text, "en", "a", 1), (1, text, "en", "a", 1), (1, sentence(rng, 80), None, None, None), (None, text + " more", "en", "b", 2), (2, None, "en", "a", 0), (3, "", None, "b", 0), (4, " \n\t ", "en", "a", 0), (5, "x" * 300_000, "en", "b", 1), (6, sentence(rng, 30_000), "en", "a", 1)]
    out = spark.createDataFrame(rows, DOCS)
    taken = set()
    for c in CLASH:
        if c.lower() not in taken:
            out = out.withColumn(c, F.lit("mine"))
            taken.add(c.lower())
    return out


def models():
    words = [f"plain{i} words{i} here" for i in range(40)]
    tox = toxicity.fit_toxicity(words + [w + " dreadful insult" for w in words], [0] * 40 + [1] * 40)
    return tox, boost.fit_boosted(np.random.default_rng(0).random((50, len(quality.NAMES))), np.arange(50) % 2.0)


OPERATORS = {
    "passages": passages.repeated_passages,
    "mix": lambda d: mix.mix_documents(d, mix.word_count(F.col("text"))),
    "toxicity": lambda d: toxicity.score_toxicity(d, models()[0]),
    "shards": lambda d: shards.shard_documents(d, F.octet_length("text"), F.col("text"), 4),
    "pack": lambda d: pack.pack_documents(d, public_tokenizers.path("word_bpe_49k.json"), 2),
    "jaccard": jaccard.jaccard_components,
    "quality": lambda d: quality.score_quality(d, models()[1]),
}
ONE_A_ROW = {"mix", "toxicity", "shards", "jaccard", "quality"}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(spark, odd, name):
    rows = OPERATORS[name](odd).collect()
    if name in ONE_A_ROW:
        assert collections.Counter(r["doc_id"] for r in rows) == collections.Counter(r["doc_id"] for r in odd.select("doc_id").collect())
    if "score" in (rows[0].asDict() if rows else {}):
        assert all(0 <= r["score"] <= 1 for r in rows)
    assert OPERATORS[name](odd.limit(0)).count() == 0


def test_columns_survive_cuts_and_scores(spark, odd):
    cut = passages.without_passages(odd, passages.repeated_passages(odd))
    assert cut.columns == odd.columns and cut.count() == odd.count()
    assert {r["key"] for r in cut.select("key").collect()} == {"mine"}
    out = scratch.free_name(odd, "toxicity")
    scored = toxicity.with_toxicity(odd, models()[0], out)
    assert scored.columns == [*odd.columns, out] and scored.where(F.col(out).isNull()).count() == 0
    assert {r["toxicity"] for r in scored.select("toxicity").collect()} == {"mine"}


def test_repeated_vectors_count_once(spark):
    rng = np.random.default_rng(12)
    v = rng.standard_normal((40, 64)).astype(np.float32)
    rows = [(i, x.tolist()) for i, x in enumerate(v)]
    extra = [(0, v[0].tolist()), (0, v[0].tolist()), (7, v[7].tolist()), (None, v[3].tolist()), (41, [0.0] * 64), (42, None), (43, [float("inf")] * 64)]
    df = spark.createDataFrame(rows + extra, "vec_id long, embedding array<float>").withColumn("query", F.lit("mine")).withColumn("vector", F.lit("mine"))
    for search, k in ((collide.nearest_by_collisions, 20), (hamming.nearest_codes, 10)):
        got = collections.defaultdict(list)
        for r in search(df, F.col("vec_id") % 10 == 0, k).collect():
            got[r["query_id"]].append((r["rank"], r["vec_id"]))
        assert set(got) == {0, 10, 20, 30}
        for q, found in got.items():
            assert sorted(r for r, _ in found) == list(range(1, k + 1))
            assert len({i for _, i in found}) == k and q not in {i for _, i in found}
        assert search(df.limit(0), F.col("vec_id") % 10 == 0, k).count() == 0
    few = collide.nearest_by_collisions(df.where("vec_id < 5"), F.col("vec_id") == 0, 20).collect()
    assert [r["vec_id"] for r in sorted(few, key=lambda r: r["rank"])] == [i for _, i in sorted((-float(v[i].astype(float) @ v[0].astype(float)), i) for i in range(1, 5))]


def test_chat_of_odd_rows(spark):
    schema = "conv_id long, turn long, role string, text string, said string, marked string"
    rows = [(None, None, None, None, "x", "y"), (1, 0, "assistant", "", "x", "y"), (1, 0, "assistant", "", "x", "y"), (2, 5, "user", "q" * 200_000, "x", "y")]
    df = spark.createDataFrame(rows, schema)
    got = {r["conv_id"]: r for r in chat.read_back(chat.chat_examples(df)).collect()}
    assert got[1]["n_turns"] == 2 and got[1]["loss_chars"] == 0 and got[2]["n_turns"] == 1 and got[None]["n_turns"] == 1
    assert chat.read_back(chat.chat_examples(df.limit(0))).count() == 0


def test_samples_are_bounded_in_rows_and_bytes(spark):
    docs = spark.createDataFrame([(i, "x" * 1000) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    assert labelled.sample_documents(docs, labels, "toxic", F.lit(True), 20).groupBy("label").count().where("count <> 20").count() == 0
    assert {r["count"] for r in labelled.sample_documents(docs, labels, "toxic", F.lit(True), 20, 5500).groupBy("label").count().collect()} == {5}


def test_a_text_above_the_bound_takes_no_others_place(spark):
    docs = spark.createDataFrame([(i, "x" * (9000 if i < 30 and i % 3 == 0 else 1000)) for i in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, toxic int")
    found = labelled.sample_documents(docs, labels, "toxic", F.lit(True), 60, 5500)
    assert {r["count"] for r in found.groupBy("label").count().collect()} == {5} and found.where("length(text) > 5500").isEmpty()


def test_shards_have_nearly_equal_bytes_end_to_end(spark):
    rng = np.random.default_rng(13)
    docs = spark.createDataFrame([(i, "y" * int(n)) for i, n in enumerate(rng.integers(1, 3000, 3000))], "doc_id long, text string")
    rows = shards.shard_documents(docs, F.octet_length("text") + 16, F.col("text"), 40)
    sums = [r["s"] for r in rows.groupBy("shard").agg(F.sum("size").alias("s")).collect()]
    assert len(sums) == 40 and max(sums) - min(sums) <= 0.002 * max(sums)


def test_first_split_is_the_best_of_all(spark):
    rng = np.random.default_rng(14)
    x = rng.random((400, 4))
    y = (x[:, 2] + 0.2 * rng.random(400) > 0.6).astype(float)
    tree = boost.fit_boosted(x, y, trees=1, depth=1, bins=64)
    p = y.mean()
    grad, hess = p - y, np.full(len(y), p * (1 - p))

    def gain(f, t):
        left = x[:, f] <= t
        if hess[left].sum() < 1 or hess[~left].sum() < 1:
            return 0
        return sum(grad[m].sum() ** 2 / (hess[m].sum() + 1) for m in (left, ~left)) - grad.sum() ** 2 / (hess.sum() + 1)

    cuts = {(f, t): gain(f, t) for f in range(4) for t in np.unique(np.quantile(x[:, f], np.linspace(0, 1, 65)[1:-1]))}
    assert gain(int(tree.feature[0, 0]), float(tree.threshold[0, 0])) >= 0.999 * max(cuts.values())
