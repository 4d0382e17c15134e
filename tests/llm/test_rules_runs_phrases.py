"""Rule cascade, periodic runs and phrases against plain versions, with odd rows and empty tables."""

import collections
import hashlib
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tarnlake.llm import phrases, queries, rules, squares

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def docs(spark):
    """Prose of few words with repeats, null and empty texts, repeated rows, null ids and langs, a long text and columns named like the operators' own."""
    rng = np.random.default_rng(31)
    word = lambda k: f"W{rng.integers(0, k)}é"
    rows = []
    for i in range(120):
        parts = [" ".join(word(12) for _ in range(int(rng.integers(0, 40)))) for _ in range(int(rng.integers(1, 6)))]
        text = str(rng.choice([". ", "\n", "\r\n", ", ", "  ", "\t"])).join(parts)
        if i % 7 == 0:
            text += "\n" + (" ".join(word(50) for _ in range(int(rng.integers(1, 9)))) + " ") * int(rng.integers(3, 9))
        if i % 11 == 0:
            text += "\nSame line here\nSame line here \nSame line here\n### $$ |"
        rows.append((i, text, [None, "en", "und", "de"][i % 4], "s", 1))
    rows += [rows[5], rows[5], (None, rows[6][1], "en", "s", 1), (200, None, "en", "s", 0), (201, "", None, None, None), (202, " \n\t\x0b ", "en", "s", 0), (203, "a " * 30_000, "en", "s", 1), (204, "x" * 300_000, "de", "s", 1)]
    out = spark.createDataFrame(rows, DOCS)
    for c in ("row", "kept", "runs", "n_words", "word", "f", "h1", "part", "phrase", "a", "l", "rank", "group", "leaves"):
        out = out.withColumn(c, F.lit("mine"))
    return out


def rows_of(docs):
    return [(r["doc_id"], r["text"] or "", r["lang"] or "und") for r in docs.select("doc_id", "text", "lang").collect()]


def stats(text):
    w = WORD.findall(text)
    seen = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
    inside = {j for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for j in range(i, i + 3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {"n_words": len(w), "word_chars": sum(map(len, w)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_lines": len(lines), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(inside)}


def broken(s):
    return [r.name for r in rules.RULES if r.test(*(np.array([s[x]]) for x in r.uses))[0]]


def test_statistics_and_verdicts_are_the_plain_ones(docs):
    got = collections.Counter((r["doc_id"], r["kept"], *(r[x] for x in rules.PER_ROW)) for r in rules.rule_cascade(docs, whole=True).collect())
    want = collections.Counter((i, not broken(s), *(s[x] for x in rules.PER_ROW)) for i, t, _ in rows_of(docs) for s in [stats(t)])
    assert got == want and sum(k[1] for k in want) > 10


@pytest.mark.parametrize("order", [[0, 1, 2, 3, 4], [4, 3, 2, 1, 0], [2, 4, 0, 3, 1]])
def test_a_cascade_stops_at_the_first_broken_rule_and_asks_for_no_more(docs, order):
    plain = collections.Counter()
    for i, t, _ in rows_of(docs):
        s = stats(t)
        bad = broken(s)
        first = next((k for k, r in enumerate(order) if rules.RULES[r].name in bad), None)
        asked = len(order) if first is None else first + 1
        known = {x for r in order[:asked] for x in rules._parts((rules.RULES[r],))}
        plain[(i, not bad, None if first is None else rules.RULES[order[first]].name, asked, *(s[x] if x in known else None for x in rules.PER_ROW))] += 1
    got = collections.Counter((r["doc_id"], r["kept"], r["rejected_by"], r["asked"], *(r[x] for x in rules.PER_ROW)) for r in rules.rule_cascade(docs, order=order).collect())
    assert got == plain


def test_rules_are_ordered_by_rejections_per_cost_of_what_is_left():
    a, b, c = (rules.Rule(n, (s,), lambda x: x) for n, s in (("a", "n_words"), ("b", "n_symbols"), ("c", "n_repeat_words")))
    cost = {"_word": 1.0, "n_words": 0.0, "n_symbols": 1.0, "n_repeat_words": 8.0}
    # c rejects most but is dear; b rejects what a does too, so after a it rejects nothing more.
    assert rules.order_rules({0: 10, 0b011: 30, 0b001: 5, 0b100: 100}, cost, (a, b, c)) == [0, 2, 1]
    assert rules.order_rules({0: 10, 0b010: 30, 0b100: 100}, cost | {"n_repeat_words": 1.0}, (a, b, c)) == [2, 1, 0]
    assert rules.order_rules({}, {}, (a, b, c)) == [0, 1, 2]


def test_measured_rules_count_every_document_of_a_small_table(docs):
    found, cost = rules.measure_rules(docs)
    assert sum(found.values()) == docs.count() and set(cost) == {*rules.PER_ROW, "_word"} - {"n_dup_lines"}  # made with n_lines
    want = collections.Counter(sum(1 << i for i, r in enumerate(rules.RULES) if r.name in broken(stats(t))) for _, t, _ in rows_of(docs))
    assert found == dict(want)


def test_judged_rows_keep_their_columns(docs):
    left = rules.judged(docs)
    assert left.columns == docs.columns and left.count() == sum(not broken(stats(t)) for _, t, _ in rows_of(docs))
    assert rules.judged(docs.limit(0)).count() == 0


def plain_runs(w, power=3, least=24):
    out = []
    for q in range(1, len(w) // power + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            s, e = i, j + q
            if j > i and e - s >= max(least, power * q) and not any(all(w[k] == w[k + p] for k in range(s, e - p)) for p in range(1, q)):
                out.append((s, e - s, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("seed", range(4))
def test_catchers_find_the_plain_runs_whole_or_word_by_word(seed):
    rng = np.random.default_rng(seed)
    some = 0
    for _ in range(60):
        n = int(rng.integers(0, 120))
        w = rng.integers(0, int(rng.integers(1, 5)), n)
        for _ in range(int(rng.integers(0, 4))):
            if n > 10:
                a, p = int(rng.integers(0, n)), int(rng.integers(1, n // 4 + 1))
                for i in range(a, min(n, a + int(rng.integers(0, n)))):
                    w[i] = w[a + (i - a) % p]
        least = int(rng.choice([1, 6, 24]))
        want = plain_runs(w.tolist(), least=least)
        some += len(want)
        for step in (n + 1, 1, int(rng.integers(2, 9))):
            c = squares.SquareCatcher()
            for i in range(0, n, step):
                c.append(w[i : i + step].astype(np.int64))
            assert [tuple(x) for x in c.runs(least).tolist()] == want
    assert some > 20


def test_query_of_runs_is_the_plain_one(spark, docs, tmp_path):
    docs.where("doc_id IS NULL OR doc_id NOT IN (203)").write.parquet(f"{tmp_path}/documents.parquet")
    got = collections.Counter(tuple(r) for r in queries.op12_periodic_runs(spark, str(tmp_path)).collect())
    want, planted = collections.Counter(), 0
    for i, t, _ in rows_of(docs):
        if i == 203:
            continue
        w = WORD.findall(t)
        h = zlib.crc32(str(i).encode()) if i is not None else 1
        if h % 10 == 0 and w:
            planted += 1
            a = h // 10 % len(w)
            p = 1 + (len(w) - a) // (3 + h // 10 % 8)
            w = [w[k] if k < a else w[a + (k - a) % p] for k in range(len(w))]
        found = plain_runs(w)
        gone = {k for s, n, q in found for k in range(s + q, s + n)}
        best = None
        for r in found:
            if best is None or r[1] * best[2] > best[1] * r[2]:
                best = r
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        want[(i, len(found), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None, digest("".join(f"{s},{n},{q}\n" for s, n, q in found)), digest(" ".join(x for k, x in enumerate(w) if k not in gone)))] += 1
    assert got == want and planted > 5 and sum(k[1] > 0 for k in want) > 10


def test_runs_of_odd_texts(spark, docs):
    got = {r["doc_id"]: r for r in squares.periodic_runs(docs).collect()}
    assert [tuple(x) for x in got[203]["runs"]] == [(0, 30_000, 1)] and got[203]["collapsed"] == "a"
    assert got[200]["runs"] == [] and got[200]["collapsed"] == "" and got[202]["collapsed"] == ""
    assert squares.periodic_runs(docs.limit(0)).count() == 0


def plain_phrases(rows, least, most=2000):
    f, n = collections.Counter(), collections.Counter()
    for _, t, lang in rows:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", re.sub("[A-Z]", lambda m: m[0].lower(), t)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, *w[i : i + m]) for m in range(1, 5) for i in range(len(w) - m + 1))
    found = {k: a for k, a in f.items() if len(k) > 2 and a >= least}
    out = []
    for (lang, *w), a in found.items():
        score, k = min((2_000_000 * a // (f[(lang, *w[:k])] + f[(lang, *w[k:])]), k) for k in range(1, len(w)))
        longer = [b for (x, *v), b in found.items() if x == lang and len(v) > len(w) and any(v[i : i + len(w)] == w for i in range(len(v)))]
        if not any(100 * b >= 80 * a for b in longer):
            out.append((lang, -score, -a, " ".join(w), f[(lang, *w[:k])], f[(lang, *w[k:])]))
    out.sort(key=lambda r: (r[0], r[1], r[2], r[3].encode()))
    rank = collections.Counter()
    for lang, score, a, phrase, left, right in out:
        rank[lang] += 1
        if rank[lang] <= most:
            yield (lang, rank[lang], phrase, -a, left, right, n[lang], -score)


@pytest.mark.parametrize(("least", "leaves", "most"), [(3, 1_000_000, 2000), (3, 40, 2000), (2, 7, 25)])
def test_phrases_are_the_plain_ones_for_any_budget(docs, least, leaves, most):
    few = docs.where("doc_id <> 203 OR doc_id IS NULL")
    got = sorted(tuple(r) for r in phrases.collocations(few, least=least, leaves=leaves, most=most).collect())
    want = sorted(plain_phrases(rows_of(few), least, most))
    assert got == want and len(want) > 30


def test_groups_stay_within_their_budget_however_frequent_a_word_is(spark):
    rng = np.random.default_rng(5)
    texts = spark.createDataFrame([(" ".join(["the"] * 3 + [f"w{rng.integers(0, 30)}" for _ in range(40)]), "en") for _ in range(200)], "text string, lang string").select("lang", "text")
    words = phrases.count_words(texts).where("f >= 2")
    bits = spark.sparkContext.broadcast(phrases.hash_filter(words.select("hash"), 40))
    cuts = phrases.vertical_cuts(texts, words, bits, 100)
    assert (cuts[1] != phrases.END).any() and len(cuts[0]) > 20
    assert [tuple(r) for r in zip(*cuts, strict=True)] == sorted(zip(*cuts, strict=True))


def test_phrases_of_an_empty_table(docs):
    assert phrases.collocations(docs.limit(0)).count() == 0
    assert phrases.collocations(docs.where("doc_id IN (200, 201, 202)")).count() == 0
