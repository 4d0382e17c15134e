"""The training-data operators against brute force, on small rows with awkward cases."""

import collections
import hashlib
import re

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tarnlake.llm import boost, chat, collide, components, hamming, jaccard, mix, pack, passages, quality, running, shards, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def make(spark, rows):
    return spark.createDataFrame([(i, t, "en", s, len(t or "")) for i, t, s in rows], DOCS)


def sentence(rng, n):
    return " ".join(f"w{rng.integers(0, 5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    """Null, empty and long texts, a null source, ties, repeated rows, copies and near copies."""
    rng = np.random.default_rng(3)
    base = [sentence(rng, int(n)) for n in rng.integers(1, 120, 40)]
    near = base[5].split() if len(base[5].split()) > 40 else sentence(rng, 60).split()
    rows = [(i, t, f"s{i % 3}") for i, t in enumerate(base)]
    rows += [(100, " ".join(near), "s0"), (101, " ".join([*near[:-1], "changed"]), "s0"), (102, None, None), (103, "", None), (104, "one", "s1"), (105, "ONE", "s1"), (106, sentence(rng, 5000), "s2"), (107, base[7], "s1"), (107, base[7], "s1"), (None, "no id here", "s1")]
    return rows


def test_jaccard_equals_brute_force(spark, corpus):
    for k, num, den in ((4, 85, 100), (5, 4, 5), (2, 1, 2)):
        sets = []
        for i, t, _ in corpus:
            w = words(t)
            sets.append((i, frozenset(tuple(w[j : j + k]) for j in range(len(w) - k + 1)) or (frozenset([tuple(w)]) if w else frozenset())))
        root = list(range(len(sets)))

        def top(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for a in range(len(sets)):
            for b in range(a):
                x, y = sets[a][1], sets[b][1]
                if x and y and den * len(x & y) >= num * len(x | y):
                    root[top(a)] = top(b)
        least = collections.defaultdict(list)
        for a, (i, _) in enumerate(sets):
            if i is not None:
                least[top(a)].append(i)
        want = collections.Counter((i, len(s), min(least[top(a)]) if s and least[top(a)] else i) for a, (i, s) in enumerate(sets))
        got = collections.Counter(tuple(r) for r in jaccard.jaccard_components(make(spark, corpus), k, num, den).collect())
        assert got == want


def test_boundary_and_subsets_by_cost():
    rule = jaccard.Rule(4, 85, 100)
    assert jaccard.light_cost(rule, 5) == 1 and jaccard.light_cost(rule, 7) == 8
    assert jaccard.boundary(rule, {5: 10, 7: 10, 30: 10}) >= 7


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (2, 3), (10, 11), (3, 9), (9, 12), (5, 5)], "a long, b long")
    assert dict(tuple(r) for r in components.connected_components(links).collect()) == {1: 1, 2: 1, 3: 1, 9: 1, 12: 1, 10: 10, 11: 10}
    assert components.connected_components(links.limit(0)).count() == 0


def test_passages_found_and_cut(spark):
    rng = np.random.default_rng(5)
    shared = sentence(rng, 60)
    edited = shared.split()
    edited[30] = "other"
    rows = [(1, sentence(rng, 30) + "\n" + shared + " " + sentence(rng, 20), "a"), (2, sentence(rng, 50) + " " + " ".join(edited) + " " + sentence(rng, 50), "a"), (3, sentence(rng, 200), "b"), (4, None, None), (5, "", "b")]
    docs = make(spark, rows)
    found = passages.repeated_passages(docs).collect()
    assert {frozenset((r["doc_id"], r["source_doc_id"])) for r in found} == {frozenset((1, 2))}
    (r,) = found
    assert r["end"] - r["start"] >= 58 and r["similarity"] >= 0.95
    cut = {x["doc_id"]: x["text"] for x in passages.without_passages(docs, passages.repeated_passages(docs)).collect()}
    assert cut[3] == rows[2][1] and cut[4] is None and set(cut) == {1, 2, 3, 4, 5}
    assert len(words(cut[r["doc_id"]])) == len(words(dict((a, b) for a, b, _ in rows)[r["doc_id"]])) - (r["end"] - r["start"])
    assert passages.repeated_passages(docs.limit(0)).count() == 0


def test_passages_around_a_foreign_block(spark):
    rng = np.random.default_rng(17)
    one, two = sentence(rng, 60), sentence(rng, 60)
    seven, nine = sentence(rng, 100), sentence(rng, 100)
    rows = [(1, f"{one} {seven} {two}", "a"), (2, f"{one} {nine} {two}", "a"), (3, sentence(rng, 30) + " " + seven, "b"), (4, sentence(rng, 30) + " " + nine, "b")]
    docs = make(spark, rows)
    left = [x["text"] for x in passages.without_passages(docs, passages.repeated_passages(docs)).collect()]
    for block in (one, seven, two, nine):
        inner = " ".join(block.split()[2:-2])
        assert sum(inner in t for t in left) == 1


def test_split_finds_all_parts_that_pass():
    a, b = np.arange(400, dtype=np.uint64), np.arange(1000, 1400, dtype=np.uint64)
    at = [(0, 30), (42, 30), (110, 6), (170, 39), (300, 50)]  # the first two pass together only, the fourth is too short
    for s, n in at:
        b[s : s + n] = a[s : s + n]
    x, size = np.array([s for s, _ in at]), np.array([n for _, n in at])
    found = passages.split(a, b, x, x, size, 40, 0.8)
    assert [(f[0], f[1]) for f in found] == [(0, 72), (300, 350)]
    assert found[0][4] == 60 / 72 and found[1][4] == 1.0


def test_passages_of_phrases_that_many_hold(spark):
    rng = np.random.default_rng(23)
    shared = sentence(rng, 60).split()
    around = lambda ws: f"{sentence(rng, 40)} {' '.join(ws)} {sentence(rng, 40)}"
    tries = [(i, around(shared), "a") for i in range(60)]
    last = sorted((r["key"], r["doc_id"]) for r in make(spark, tries).select("doc_id", passages.row_key().alias("key")).collect())[-2:]
    both = {i for _, i in last}  # of late keys, so a seed's first holders have a phrase of 30 words only
    rows = [r for r in tries if r[0] in both]
    rows += [(100 + 20 * o + i, around(shared[o : o + 30]), "b") for o in (0, 10, 20, 30) for i in range(12)]
    docs = make(spark, rows)
    found = passages.repeated_passages(docs)
    assert {r["doc_id"] for r in found.select("doc_id").collect()} <= both
    left = [words(x["text"]) for x in passages.without_passages(docs, found).collect()]
    runs = [shared[i : i + 40] for i in range(21)]
    assert [sum(any(t[j : j + 40] == r for j in range(len(t) - 39)) for t in left) for r in runs] == [1] * 21


def test_near_copies_behind_many_holders_of_their_seeds(spark):
    rng = np.random.default_rng(29)
    shared = sentence(rng, 60).split()
    edited = shared.copy()
    edited[20] = edited[41] = "other"
    around = lambda ws: f"{sentence(rng, 40)} {' '.join(ws)} {sentence(rng, 40)}"
    keys = lambda rows: {r["doc_id"]: r["key"] for r in make(spark, rows).select("doc_id", passages.row_key().alias("key")).collect()}
    tries = [(i, around(shared if i % 2 else edited), "a") for i in range(80)]
    late = sorted(tries, key=lambda r, k=keys(tries): k[r[0]])
    rows = [next(r for r in reversed(late) if r[0] % 2 == p) for p in (0, 1)]
    both = {r[0] for r in rows}
    rows += [(100 + 20 * o + i, around(shared[o : o + 26]), "b") for o in (0, 12, 22, 34) for i in range(9)]
    found = passages.repeated_passages(make(spark, rows)).collect()
    assert {frozenset((r["doc_id"], r["source_doc_id"])) for r in found} == {frozenset(both)}
    assert max(r["end"] - r["start"] for r in found) >= 58


def test_chain_is_collinear_and_pays_for_gaps():
    x, y, size = np.array([0, 10, 20, 400]), np.array([5, 15, 2, 405]), np.full(4, 6)
    first = passages.chain(x, y, size)[0].tolist()
    assert first == [0, 1]


def test_mix_fills_targets(spark, corpus):
    docs = make(spark, corpus)
    rows = mix.mix_documents(docs, mix.word_count(F.col("text"))).collect()
    assert len(rows) == len(corpus)
    by = collections.defaultdict(lambda: [0, 0.0, 0])
    for r in rows:
        assert 0 <= r["taken"] <= 2 * r["size"]
        by[r["source_size"], r["target"]][2] += r["taken"]
    total = sum(len(words(t)) for _, t, _ in corpus)
    assert sum(t for _, t in by) == pytest.approx(1.5 * total, rel=1e-9)
    again = mix.mix_documents(docs.repartition(3), mix.word_count(F.col("text"))).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, again))
    assert mix.mix_documents(docs.limit(0), mix.word_count(F.col("text"))).count() == 0


def test_shards_keep_groups_and_balance(spark, corpus):
    docs = make(spark, corpus)
    rows = shards.shard_documents(docs, F.octet_length(F.coalesce("text", F.lit(""))) + 16, F.unhex(F.sha2("text", 256)), 4).collect()
    assert len(rows) == len(corpus)
    for s in range(4):
        assert sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert len({r["shard"] for r in rows if r["doc_id"] in (7, 107)}) == 1
    rng = np.random.default_rng(1)
    sizes = rng.integers(1, 10_000, 2000)
    sums = np.bincount(shards.differencing(sizes.tolist(), 40), weights=sizes, minlength=40)
    assert sums.max() - sums.min() <= 3


def test_packing_round_trip(spark, corpus):
    path = public_tokenizers.path("word_bpe_49k.json")
    tok = Tokenizer.from_file(path)
    docs = make(spark, [r for r in corpus if r[0] != 107])
    rows = pack.pack_documents(docs, path, 2, 256).collect()
    pieces = collections.defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
    for i, t, _ in corpus:
        if i != 107:
            want = [*tok.encode(t or "", add_special_tokens=False).ids, 2]
            got = np.concatenate([np.frombuffer(p["ids"], "<u4") for p in sorted(pieces[i], key=lambda p: p["start"])]).tolist()
            assert got == want
    fill = collections.Counter()
    for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
        assert r["offset"] == fill[r["sequence_id"]]
        fill[r["sequence_id"]] += r["length"]
    assert all(n == 256 for s, n in fill.items() if s != max(fill))
    assert pack.pack_documents(docs.limit(0), path, 2).count() == 0


def test_units_are_placed_as_a_simulated_round_robin_would(spark):
    rng = np.random.default_rng(6)
    sizes = {None: rng.integers(1, 900, 12), "a": rng.integers(1, 2000, 30), "b": rng.integers(1, 60, 80), **{f"s{i}": [int(rng.integers(1, 300))] for i in range(300)}}
    rows = [(i, i % 50, s, int(n)) for i, (s, n) in enumerate((s, n) for s, v in sizes.items() for n in v)]
    quanta = {s: int(rng.integers(1, 40)) << pack.PLACES for s in sizes}
    narrow = spark.createDataFrame(rows, "row long, doc_id long, source string, tokens long")
    total = sum(r[3] for r in rows)
    got = pack.place_units(narrow, spark.createDataFrame(list(quanta.items()), "of string, quantum long"), 256, total, len(rows), 100).collect()
    part = running.hash_bucket(F.xxhash64("doc_id", "row"), running.bucket_count(len(rows)))
    order = {r["row"]: (r["p"], r["m"], r["row"]) for r in narrow.select("row", part.alias("p"), F.xxhash64("doc_id").alias("m")).collect()}
    turn = {r["of"]: r["q"] for r in spark.createDataFrame([(s,) for s in sizes], "of string").select("of", F.xxhash64("of").alias("q")).collect()}
    queues = {s: [(r[0], a, min(100, r[3] - a)) for r in sorted((r for r in rows if r[2] == s), key=lambda r: order[r[0]]) for a in range(0, r[3], 100)] for s in sizes}
    deficit, want, place = dict.fromkeys(sizes, 0), {}, 0
    while any(queues.values()):
        for s in sorted(sizes, key=lambda s: turn[s]):
            deficit[s] += quanta[s] if queues[s] else 0
            while queues[s] and queues[s][0][2] << pack.PLACES <= deficit[s]:
                row, a, n = queues[s].pop(0)
                deficit[s] -= n << pack.PLACES
                want[row, a] = (n, place)
                place += n
    assert {(r["row"], r["start"]): (r["length"], r["place"]) for r in got} == want


def test_packing_follows_proportions(spark):
    rng = np.random.default_rng(8)
    docs = make(spark, [(i, sentence(rng, int(rng.integers(5, 400))), f"s{i % 3}") for i in range(240)])
    rows = pack.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"), 2, 4096, {"s0": 0.6, "s1": 0.3}).collect()
    of = {i: f"s{i % 3}" for i in range(240)}
    ends = max(r["sequence_id"] for r in rows if of[r["doc_id"]] == "s0")
    for window in range(0, ends - 1):
        held = collections.Counter()
        for r in rows:
            if r["sequence_id"] == window:
                held[of[r["doc_id"]]] += r["length"]
        for s, p in (("s0", 0.6), ("s1", 0.3), ("s2", 0.1)):
            assert abs(held[s] - p * 4096) <= 2 * pack.UNIT + 4096 * 0.02


def test_chat_reads_back(spark):
    bad = "a\\<|im_end|>\n<|im_start|>\\"
    rows = [(1, 0, "user", bad), (1, 1, "assistant", bad), (1, 2, "user", None), (2, 0, "user", "x"), (3, 1, None, "é"), (3, 0, "assistant", "<"), (3, 2, "a\nb\\", "|>")]
    got = {r["conv_id"]: r for r in chat.read_back(chat.chat_examples(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    for c in (1, 2, 3):
        turns = sorted((t, r or "", x or "") for k, t, r, x in rows if k == c)
        reply = "".join(x for _, r, x in turns if r == "assistant")
        assert got[c]["n_turns"] == len(turns)
        assert got[c]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{x}\n" for _, r, x in turns).encode()).hexdigest()
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(reply), hashlib.sha256(reply.encode()).hexdigest())


def vectors(spark, n=600):
    rng = np.random.default_rng(2)
    v = rng.standard_normal((n, 64)).astype(np.float32)
    v[50:80] = v[50]
    rows = [(i, x.tolist(), 0) for i, x in enumerate(v)] + [(n, None, 0), (n + 1, [0.0] * 64, 0), (n + 2, [float("nan")] * 64, 0), (n + 3, [None] * 64, 0)]
    return v, spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_collisions_do_not_depend_on_what_is_asked_together(spark):
    """More queries than are asked at a time, in other orders, partitions and company: each gets the same answer."""
    rng = np.random.default_rng(7)
    rows = [(int(i), [float(x) for x in rng.standard_normal(24)]) for i in range(1500)]
    answers = []
    for seed, parts, few in ((1, 3, False), (2, 7, False), (3, 5, True)):
        df = spark.createDataFrame([rows[i] for i in np.random.default_rng(seed).permutation(len(rows))], "vec_id long, embedding array<double>").repartition(parts)
        found = collide.nearest_by_collisions(df, (F.col("vec_id") % (20 if few else 4)) == 0, 5).collect()
        answers.append(sorted(tuple(r) for r in found if r["query_id"] % 20 == 0))
    assert len(answers[0]) == 75 * 5
    assert answers[0] == answers[1] == answers[2]


def test_collisions_are_counted_from_the_shorter_side():
    """Windows of every width, empty and full ones too, counted at once or as they grow, against one comparison each."""
    rng = np.random.default_rng(11)
    arrays = collide.Arrays(np.arange(700), rng.standard_normal((700, 16)) * rng.uniform(0.1, 1, (700, 1)))
    values = np.empty_like(arrays.values)
    np.put_along_axis(values, arrays.rows, arrays.values, axis=1)
    at = rng.standard_normal(collide.PROJECTIONS)
    before = None
    for half in (0.0, 0.2, 0.8, 1.5, 9.0):
        left, right = (x[0] for x in arrays.windows(at[None], half))
        plain = ((values >= (at - half).astype(np.float32)[:, None]) & (values <= (at + half).astype(np.float32)[:, None])).sum(axis=0)
        assert (arrays.collisions(left, right) == plain).all()
        if before:
            assert (before[2] + arrays.grown(left, before[0], before[1], right) == plain).all()
        before = left, right, plain
    assert plain.min() == collide.PROJECTIONS


def test_collisions_recall(spark):
    v, df = vectors(spark)
    got = collections.defaultdict(list)
    for r in collide.nearest_by_collisions(df, F.col("vec_id") % 20 == 0).collect():
        got[r["query_id"]].append((r["rank"], r["vec_id"], r["score"]))
    hits = 0
    w = v.astype(np.float64)
    for q, rows in got.items():
        score = (w * w[q]).sum(axis=1)
        best = sorted((-s, i) for i, s in enumerate(score) if i != q)[:20]
        hits += len({i for _, i in best} & {i for _, i, _ in rows})
        assert all(s == pytest.approx(score[i], abs=1e-12) for _, i, s in rows) and len(rows) == 20
    assert set(got) == set(range(0, 600, 20)) and hits >= 0.9 * 20 * len(got)


def test_hamming_is_exact(spark):
    v, df = vectors(spark)
    bits = v > 0
    rows = hamming.nearest_codes(df, F.col("vec_id") % 100 == 0).collect()
    for q in range(0, 600, 100):
        want = sorted((int((bits[i] != bits[q]).sum()), i) for i in range(600) if i != q)[:10]
        assert [(r["distance"], r["vec_id"]) for r in sorted(rows, key=lambda r: r["rank"]) if r["query_id"] == q] == want


def test_boosted_trees_learn_and_traverse():
    rng = np.random.default_rng(0)
    x = rng.random((2000, 5))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.3)).astype(float)
    p = boost.fit_boosted(x[:1500], y[:1500]).probability(x[1500:])
    assert ((p > 0.5) == y[1500:]).mean() > 0.95
    assert boost.fit_boosted(x[:0], y[:0]).probability(x[:3]).tolist() == [0.5] * 3


def test_classifiers_on_held_out_rows(spark, sf):
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    folds = F.crc32(F.col("doc_id").cast("string"))
    scored = quality.score_quality(docs, quality.learn_quality(docs, labels, folds % 4 != 2)).join(labels, "doc_id").where(folds % 4 == 2).collect()
    assert np.mean([(r["score"] >= 0.7) == (r["quality"] == 1) for r in scored]) >= 0.85
    model = toxicity.learn_toxicity(docs, labels, folds % 3 != 1)
    assert toxicity.score_toxicity(docs, model).count() == docs.count()
    odd = make(spark, [(1, None, "a"), (2, "", None), (3, "x" * 200_000, "a")])
    assert all(0 <= r["score"] <= 1 for r in toxicity.score_toxicity(odd, model).collect())
    rng = np.random.default_rng(4)
    texts = [sentence(rng, 40) + (" you idiot and scum " + sentence(rng, 10) if i % 2 else "") for i in range(200)]
    learnt = toxicity.fit_toxicity(texts, [i % 2 for i in range(200)])
    told = toxicity.score_toxicity(make(spark, [(1, sentence(rng, 20) + " you idiot and scum", "a"), (2, sentence(rng, 20), "a")]), learnt)
    assert {r["doc_id"]: r["score"] >= 0.7 for r in told.collect()} == {1: True, 2: False}
