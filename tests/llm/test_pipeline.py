"""The stages of the corpus pipeline, each against what its docstring says, worked out plainly."""

import collections
import re

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def sentence(rng, n):
    return " ".join(f"w{rng.integers(0, 5000)}" for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = np.random.default_rng(21)
    rows = [(i, sentence(rng, int(rng.integers(60, 200))), "en", f"s{i % 4}", 0) for i in range(80)]
    rows += [(100 + i, f"{sentence(rng, 40)} dreadful insult {sentence(rng, 30)} dreadful", "en", "s1", 0) for i in range(30)]
    near = rows[3][1].split()
    rows += [(200, " ".join([*near[:-1], "changed"]), "en", "s2", 0), (200, sentence(rng, 70), "en", "s2", 0), (201, rows[4][1], "en", "s3", 0), (202, rows[4][1], "en", "s3", 0)]
    shared = sentence(rng, 60)
    rows += [(300 + i, f"{sentence(rng, 60)} {shared} {sentence(rng, 60)}", "en", "s0", 0) for i in range(3)]
    rows += [(400, None, "en", "s0", 0), (401, "", None, None, None), (5, rows[5][1], "en", "s1", 0), (None, sentence(rng, 50), "en", "s1", 0)]
    path = str(tmp_path_factory.mktemp("pipeline"))
    spark.createDataFrame([(i, t, a, b, len(t or "")) for i, t, a, b, _ in rows], DOCS).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, int("insult" in (t or "")), 1) for i, t, *_ in rows if i is not None and t], "doc_id long, toxic int, quality int").write.parquet(f"{path}/labels.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder):
    docs, out = spark.read.parquet(f"{folder}/documents.parquet"), {}
    out["documents"] = docs
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.keep(stage(spark, docs, folder), f"test-{name}")
        out[name] = docs
    return out


def pairs(df):
    return collections.Counter((r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect())


def test_toxic_documents_go_and_only_those(stages):
    before, after = pairs(stages["documents"]), pairs(stages["toxicity"])
    gone = before - after
    assert not after - before
    assert sum("insult" in t for _, t in gone) >= 28 and all(t and "insult" in t for _, t in gone)


def test_one_of_each_group_of_near_copies_stays(stages):
    before, after = pairs(stages["toxicity"]), pairs(stages["jaccard"])
    rows = sorted(before, key=lambda r: (r[0] is None, r[0] or 0))
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if (w := words(t)) else set() for _, t in rows]
    root = list(range(len(rows)))

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 5 * len(sets[a] & sets[b]) >= 4 * len(sets[a] | sets[b]):
                root[max(top(a), top(b))] = min(top(a), top(b))
    kept = collections.defaultdict(list)
    for a, r in enumerate(rows):
        if sets[a]:
            kept[top(a)].append(r)
    assert all(n == 1 for n in after.values())
    for group in kept.values():
        stay = [r for r in group if after[r]]
        assert len(stay) == 1 and stay[0][0] == group[0][0]
    assert all(after[r] for a, r in enumerate(rows) if not sets[a])


def test_no_passage_stays_in_two_documents(stages):
    before, after = pairs(stages["jaccard"]), pairs(stages["passages"])
    assert sum(before.values()) == sum(after.values())
    seen = collections.defaultdict(set)
    for n, (_, t) in enumerate(after):
        w = words(t)
        for i in range(len(w) - 39):
            seen[tuple(w[i : i + 40])].add(n)
    assert all(len(x) == 1 for x in seen.values())
    alone = [r for r in before if r[0] is not None and r[0] < 80]
    assert all(after[r] for r in alone)


def test_mix_repeats_documents_towards_targets(stages):
    before, after = pairs(stages["passages"]), pairs(stages["mix"])
    assert set(after) <= set(before) and all(n <= 2 for n in after.values())
    assert all(after[r] == 1 for r in before if not words(r[1]))
    size = sum(len(words(t)) * n for (_, t), n in before.items())
    taken = sum(len(words(t)) * n for (_, t), n in after.items())
    assert abs(taken - 1.5 * size) <= max(len(words(t)) for _, t in before)
    assert stages["mix"].columns == stages["documents"].columns


def test_packs_hold_every_id_of_the_mix(stages):
    tok = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    want = collections.Counter()
    for (_, t), n in pairs(stages["mix"]).items():
        want.update({i: c * n for i, c in collections.Counter([*tok.encode(t or "", add_special_tokens=False).ids, corpus_pipeline.END_ID]).items()})
    got, fill = collections.Counter(), collections.Counter()
    for r in stages["pack"].collect():
        got.update(np.frombuffer(r["ids"], "<u4").tolist())
        fill[r["sequence_id"]] += r["length"]
    assert got == want
    assert all(n == corpus_pipeline.WINDOW for s, n in fill.items() if s != max(fill))


def test_run_applies_all_stages(spark, folder, stages):
    assert corpus_pipeline.run(spark, folder).count() == stages["pack"].count()
