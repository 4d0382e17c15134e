"""Phrases that occur together more than their parts do, counted in suffix subtrees of word prefixes that fit a budget."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.llm.running import bucket_count, total_before
from tarnlake.llm.scratch import importable, keep
from tarnlake.llm.words import array_bytes, encoded_words, lower, mix, span_hashes, text_runs

#: Words in a phrase, at most: the depth at which suffixes are cut.
DEPTH = 4
#: Occurrences of words that a group of prefixes has, about; and groups, at most (beyond, they get larger).
LEAVES, MOST_GROUPS = 1_000_000, 1 << 20
#: Bytes of text that a task counts at once, and bits of the filter of frequent words, at most.
FLUSH, MOST_BITS = 8_000_000, 1 << 27
#: Where texts are cut into pieces, and what lies between words.
CUTS, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_CUT = np.isin(np.arange(256), np.frombuffer(CUTS, np.uint8))
_APART = _CUT | np.isin(np.arange(256), np.frombuffer(BLANKS, np.uint8))
#: Stands for the end of a suffix: before every word's hash.
END = np.int64(np.iinfo(np.int64).min)


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
    """(lang, bytes, offsets) of whole texts of one language, about ``FLUSH`` bytes at once."""
    held: dict[str, list[pa.Array]] = {}
    size = 0

    def out() -> Iterator[tuple[str, np.ndarray, np.ndarray]]:
        for lang, parts in held.items():
            for _, data, offsets in text_runs(pa.chunked_array(parts), FLUSH):
                yield lang, data, offsets

    for batch in batches:
        coded = batch["lang"].dictionary_encode()
        kind = coded.indices.to_numpy(zero_copy_only=False)
        for i, lang in enumerate(coded.dictionary.to_pylist()):
            held.setdefault(lang, []).append(batch["text"].take(pa.array(np.flatnonzero(kind == i))))
        size += batch["text"].nbytes
        if size >= FLUSH:
            yield from out()
            held, size = {}, 0
    yield from out()


class Words:
    """The words of some texts of a language: their numbers in order, the piece that each lies in, and the distinct words with their hashes."""

    def __init__(self, lang: str, data: np.ndarray, offsets: np.ndarray) -> None:
        data = lower(data)
        apart = _APART[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        inside = np.r_[False, ~apart, False]
        starts = np.flatnonzero(inside[1:] & (~inside[:-1] | edge))
        ends = np.flatnonzero(inside[:-1] & (~inside[1:] | edge))
        cuts = np.cumsum(_CUT[data])
        self.piece = (cuts[starts] if len(starts) else starts) + np.searchsorted(offsets, starts, side="right")
        self.word, self.distinct = encoded_words(data, ~apart, ends - starts)
        text, at = array_bytes(self.distinct)
        name = np.frombuffer(lang.encode(), dtype=np.uint8)
        own = span_hashes(name, np.array([0]), np.array([len(name)]))[0]
        self.hash = mix(span_hashes(text, at[:-1], at[1:]) ^ own).view(np.int64)


def _strings(words: pa.LargeBinaryArray) -> pa.Array:
    return words.cast(pa.large_string()).cast(pa.string())


def count_words(docs: DataFrame) -> DataFrame:
    """``lang, word, hash, f`` of all words of ``docs`` (``lang, text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data, offsets in _texts(batches):
            w = Words(lang, data, offsets)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(w.distinct), pa.string()), _strings(w.distinct), pa.array(w.hash), pa.array(np.bincount(w.word, minlength=len(w.distinct)))], ["lang", "word", "hash", "f"])

    found = docs.mapInArrow(run, "lang string, word string, hash long, f long")
    return found.groupBy("lang", "word").agg(F.first("hash").alias("hash"), F.sum("f").alias("f"))


def hash_filter(hashes: DataFrame, rows: int) -> np.ndarray:
    """A bit array with the bits of all ``hash``es set, of a power of two of bits; it lets others through too, never fewer.

    Sixteen bits a hash, ``MOST_BITS`` at most. Tasks make stretches of it; the driver puts them in a row.
    """
    bits = min(MOST_BITS, max(1 << 16, 1 << (16 * rows).bit_length()))
    stretch = bits // 64

    def run(table: pa.Table) -> pa.Table:
        slots = table["slot"].to_numpy()
        own = np.zeros(stretch, dtype=bool)
        own[slots % stretch] = True
        return pa.table({"part": pa.array([int(slots[0]) // stretch]), "bits": pa.array([np.packbits(own).tobytes()])})

    slot = F.col("hash").bitwiseAND(F.lit(bits - 1))
    slots = hashes.select(slot.alias("slot"), F.floor(slot / stretch).cast("long").alias("part")).distinct()
    out = np.zeros(bits // 8, dtype=np.uint8)
    for r in slots.groupBy("part").applyInArrow(run, "part long, bits binary").collect():
        out[r["part"] * stretch // 8 : (r["part"] + 1) * stretch // 8] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def passes(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    """Which hashes a filter of ``hash_filter`` lets through."""
    at = h & np.int64(len(bits) * 8 - 1)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 > 0


class Leaves:
    """Suffixes of the texts, cut after four words, at the end of a piece and before words that are not frequent; equal ones with their count.

    ``ids`` has a column for each word of a leaf: its place among ``words``, which are sorted by hash, from 1; 0 stands for
    nothing. Leaves are sorted. Those of a single word aren't kept.
    """

    def __init__(self, w: Words, bits: np.ndarray) -> None:
        used = np.flatnonzero(passes(bits, w.hash))
        used = used[np.argsort(w.hash[used], kind="stable")]
        place = np.zeros(len(w.hash), dtype=np.uint64)
        place[used] = np.arange(1, len(used) + 1)
        v = np.r_[place[w.word], np.zeros(DEPTH, np.uint64)] if len(w.word) else np.zeros(DEPTH, np.uint64)
        piece = np.r_[w.piece, np.full(DEPTH, -1)]
        n = len(w.word)
        columns, goes_on = [v[:n]], v[:n] > 0
        for k in range(1, DEPTH):
            goes_on = goes_on & (piece[k : n + k] == piece[:n]) & (v[k : n + k] > 0)
            columns.append(np.where(goes_on, v[k : n + k], np.uint64(0)))
        real = np.flatnonzero(columns[1])
        self.ids, self.count = distinct_rows([c[real] for c in columns], np.ones(len(real), dtype=np.int64), len(used))
        self.words = w.distinct.take(pa.array(used))
        self.hash = np.r_[END, w.hash[used]]


def distinct_rows(columns: list[np.ndarray], count: np.ndarray, most: int) -> tuple[list[np.ndarray], np.ndarray]:
    """Distinct rows of four columns of numbers from 0 to ``most``, sorted, with the sums of their counts."""
    bits = np.uint64(max(1, int(most).bit_length()))
    one = bool((count == 1).all())
    if DEPTH * int(bits) <= 64:
        key = columns[0]
        for c in columns[1:]:
            key = key << bits | c
        if one:
            key = np.sort(key)
        else:
            order = np.argsort(key, kind="stable")
            key, count = key[order], count[order]
        new = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][: len(key)])
        key = key[new]
        columns = [key >> (np.uint64(DEPTH - 1 - i) * bits) & ((np.uint64(1) << bits) - np.uint64(1)) for i in range(DEPTH)]
    else:
        high, low = (a << np.uint64(32) | b for a, b in (columns[:2], columns[2:]))
        order = np.lexsort((low, high))
        columns, count = [c[order] for c in columns], count[order]
        high, low = high[order], low[order]
        new = np.flatnonzero(np.r_[True, (high[1:] != high[:-1]) | (low[1:] != low[:-1])][: len(high)])
        columns = [c[new] for c in columns]
    return columns, np.add.reduceat(count, new) if len(new) else np.zeros(0, np.int64)


def _joined(h: list[np.ndarray]) -> np.ndarray:
    """One number for the first words of a leaf."""
    out = h[0].view(np.uint64)
    for x in h[1:]:
        out = mix(out + x.view(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    return out


def grown_prefixes(docs: DataFrame, heavy: DataFrame, depth: int, bits: Any) -> DataFrame:
    """Prefixes one word longer than the ``heavy`` ones of ``depth`` words, with their occurrences."""
    spark = docs.sparkSession
    names = [f"h{k + 1}" for k in range(DEPTH - 1)]
    known = spark.sparkContext.broadcast(np.sort(_joined([np.array(c, dtype=np.int64) for c in zip(*heavy.select(*names[:depth]).collect(), strict=True)])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data, offsets in _texts(batches):
            leaves = Leaves(Words(lang, data, offsets), bits.value)
            h = [leaves.hash[c.astype(np.int64)] for c in leaves.ids[: depth + 1]]
            has = np.isin(_joined(h[:depth]), known.value)
            h, count = [x[has] for x in h], leaves.count[has]
            new = np.flatnonzero(np.r_[True, np.logical_or.reduce([x[1:] != x[:-1] for x in h])][: len(count)])
            total = np.add.reduceat(count, new) if len(new) else count
            rest = [np.full(len(new), END)] * (DEPTH - 2 - depth)
            yield pa.RecordBatch.from_arrays([*(pa.array(x[new]) for x in h), *map(pa.array, rest), pa.array(total)], [*names, "f"])

    found = docs.mapInArrow(run, ", ".join(f"{x} long" for x in [*names, "f"]))
    return found.groupBy(*names).agg(F.sum("f").alias("f"))


def vertical_cuts(docs: DataFrame, words: DataFrame, bits: Any, leaves: int = LEAVES) -> list[np.ndarray]:
    """First prefixes (three hashes) of groups of prefixes that lie in a row and have about ``leaves`` occurrences together.

    A prefix is a word of a language; one with more than ``leaves`` occurrences is replaced by its continuations of
    two words, and those again by three. Prefixes are summed up in the order of their hashes; a group begins where
    the sum passes a multiple of the budget. Only groups' first prefixes reach the driver.
    """
    names = [f"h{k + 1}" for k in range(DEPTH - 1)]
    prefixes = words.select(F.col("hash").alias("h1"), *[F.lit(int(END)).alias(x) for x in names[1:]], "f").groupBy(*names).agg(F.sum("f").alias("f"))
    rows, total = prefixes.agg(F.count("*"), F.coalesce(F.sum("f"), F.lit(0))).first()
    budget = max(leaves, math.ceil(total / MOST_GROUPS))
    for depth in range(1, DEPTH - 1):
        heavy = (F.col("f") > budget) & (F.col(names[depth - 1]) != int(END)) & (F.col(names[depth]) == int(END))
        large = prefixes.where(heavy)
        if large.isEmpty():
            break
        prefixes = keep(prefixes.where(~heavy).unionByName(grown_prefixes(docs, large, depth, bits)), "prefixes")
    buckets = bucket_count(rows)
    part = (F.shiftright("h1", 64 - buckets.bit_length() + 1) + buckets // 2).cast("int")
    summed = total_before(prefixes.withColumn("part", part), [], "part", names, "f", "before")
    firsts = summed.groupBy(F.floor(F.col("before") / budget).alias("g")).agg(F.min(F.struct(*names)).alias("at")).select("at.*").orderBy(*names)
    found = [tuple(r) for r in firsts.collect()]
    return [np.array([r[k] for r in found], dtype=np.int64) for k in range(DEPTH - 1)]


def group_of(h: list[np.ndarray], cuts: list[np.ndarray]) -> np.ndarray:
    """How many of the sorted ``cuts`` are no greater than each row of hashes, compared word by word."""
    out = np.searchsorted(cuts[0], h[0], side="right")
    if len(cuts) > 1:
        longer = np.unique(cuts[0][cuts[1] != END])
        for v in longer[np.isin(longer, h[0])]:
            rows = np.flatnonzero(h[0] == v)
            a, b = np.searchsorted(cuts[0], v, side="left"), np.searchsorted(cuts[0], v, side="right")
            out[rows] = a + group_of([x[rows] for x in h[1:]], [c[a:b] for c in cuts[1:]])
    return out


def _packed(leaves: Leaves, begin: int, end: int) -> bytes:
    """Leaves ``begin`` to ``end`` with the words that they have."""
    ids = np.stack([c[begin:end] for c in leaves.ids]).astype(np.int64)
    used = np.unique(ids[ids > 0])
    small = np.uint16 if len(used) < 65_000 else np.uint32
    place = np.where(ids > 0, np.searchsorted(used, ids) + 1, 0).astype(small)
    words = b" ".join(leaves.words.take(pa.array(used - 1)).to_pylist())
    head = np.array([len(used), end - begin, len(words)], dtype=np.int64).tobytes()
    return zstandard.ZstdCompressor(level=1).compress(head + words + place.tobytes() + leaves.count[begin:end].astype(np.int64).tobytes())


def _unpacked(blob: bytes) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    used, n, size = np.frombuffer(raw, dtype=np.int64, count=3)
    small = np.dtype(np.uint16 if used < 65_000 else np.uint32)
    at = 24 + int(size)
    ids = np.frombuffer(raw, dtype=small, count=DEPTH * n, offset=at).reshape(DEPTH, n)
    return raw[24:at].split(b" ") if used else [], ids, np.frombuffer(raw, dtype=np.int64, count=n, offset=at + DEPTH * int(n) * small.itemsize)


def subtree_phrases(lang: str, blobs: list[bytes], least: int, edges: set[tuple[int, int]]) -> tuple[list[str], list[int]]:
    """Phrases of two words and more below a group's prefixes, with the totals of the leaves under their nodes.

    Nodes with fewer than ``least`` occurrences are left out, but for word pairs in ``edges``, of which another group has a share.
    """
    parts = [_unpacked(b) for b in blobs]
    coded = pa.array([w for words, _, _ in parts for w in words], pa.large_binary()).dictionary_encode()
    number = coded.indices.to_numpy(zero_copy_only=False).astype(np.uint64) + np.uint64(1)
    first = np.cumsum([0, *(len(words) for words, _, _ in parts)])
    own = [np.r_[np.uint64(0), number[first[i] : first[i + 1]]] for i in range(len(parts))]
    columns = [np.concatenate([o[ids[k]] for o, (_, ids, _) in zip(own, parts, strict=True)]) for k in range(DEPTH)]
    ids, count = distinct_rows(columns, np.concatenate([c for _, _, c in parts]), len(coded.dictionary))
    words = [w.decode() for w in coded.dictionary.to_pylist()]
    new = np.zeros(len(count), dtype=bool)
    if len(new):
        new[0] = True
    phrases, totals = [], []
    for k in range(DEPTH):
        new[1:] |= ids[k][1:] != ids[k][:-1]
        at = np.flatnonzero(new)
        if not k or not len(at):
            continue
        total = np.add.reduceat(count, at)
        wanted = (ids[k][at] > 0) & (total >= least)
        if k == 1 and edges:
            text, offset = array_bytes(coded.dictionary)
            name = np.frombuffer(lang.encode(), dtype=np.uint8)
            h = mix(span_hashes(text, offset[:-1], offset[1:]) ^ span_hashes(name, np.array([0]), np.array([len(name)]))[0]).view(np.int64)
            for a, b in edges:
                wanted |= (h[(ids[0][at] - np.uint64(1)).astype(np.int64)] == a) & (h[(ids[1][at] - np.uint64(1)).astype(np.int64)] == b)
        nodes = at[wanted]
        phrases += [" ".join(words[i - 1] for i in node) for node in zip(*(ids[j][nodes].astype(np.int64).tolist() for j in range(k + 1)), strict=True)]
        totals += total[wanted].tolist()
    return phrases, totals


def count_phrases(docs: DataFrame, words: DataFrame, least: int, leaves: int = LEAVES) -> DataFrame:
    """``lang, phrase, m, f`` of all phrases of two to four words (``m``) with ``least`` occurrences (``f``) or more."""
    frequent = words.where(F.col("f") >= least)
    send = docs.sparkSession.sparkContext.broadcast
    bits = send(hash_filter(frequent.select("hash"), frequent.count()))
    cuts = send(vertical_cuts(docs, frequent, bits, leaves))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, data, offsets in _texts(batches):
            found = Leaves(Words(lang, data, offsets), bits.value)
            group = group_of([found.hash[c.astype(np.int64)] for c in found.ids[: DEPTH - 1]], cuts.value)
            begin = np.flatnonzero(np.r_[True, group[1:] != group[:-1]][: len(group)]).tolist()
            for a, b in zip(begin, [*begin[1:], len(group)], strict=False):  # no leaves: nothing begins
                yield pa.RecordBatch.from_arrays([pa.array([int(group[a])]), pa.array([lang]), pa.array([_packed(found, a, b)], pa.binary())], ["group", "lang", "leaves"])

    def build(table: pa.Table) -> pa.Table:
        group, every = table["group"][0].as_py(), cuts.value
        edges = {(int(every[0][i]), int(every[1][i])) for i in (group - 1, group) if 0 <= i < len(every[0]) and every[2][i] != END}
        langs, out = table["lang"].to_pylist(), ([], [], [])
        for lang in sorted(set(langs)):
            phrases, totals = subtree_phrases(lang, [b for x, b in zip(langs, table["leaves"].to_pylist(), strict=True) if x == lang], least, edges)
            for column, more in zip(out, ([lang] * len(phrases), phrases, totals), strict=True):
                column.extend(more)
        return pa.table([pa.array(out[0], pa.string()), pa.array(out[1], pa.string()), pa.array(out[2], pa.int64())], names=["lang", "phrase", "f"])

    dealt = docs.mapInArrow(deal, "group long, lang string, leaves binary")
    nodes = dealt.groupBy("group").applyInArrow(build, "lang string, phrase string, f long")
    whole = nodes.groupBy("lang", "phrase").agg(F.sum("f").alias("f")).where(F.col("f") >= least)
    return whole.select("lang", "phrase", F.size(F.split("phrase", " ")).alias("m"), "f")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", least: int = 30, contained: tuple[int, int] = (80, 100), most: int = 2000, leaves: int = LEAVES) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's ``most`` phrases of two to four words by score.

    Words are lower-cased in A-Z, lie between blanks and never cross ``CUTS``. ``a`` counts a phrase's occurrences, ``l``
    and ``r`` those of its two parts at the cut of lowest score, floor(2,000,000 a / (l + r)), ties to the earlier cut;
    ``n`` counts the language's words. Phrases with fewer than ``least`` occurrences are no candidates; those that lie in
    a longer candidate with ``contained`` of their occurrences or more are dropped.

    Words are counted first. Prefixes (words, and longer ones where a word passes the budget ``leaves``) are put in
    groups by their occurrences; every position sends its suffix, cut after four words, to the group of its prefix, as
    compressed leaves with the words they need; a group's subtree is built alone, and phrases are read
    from it with the totals of its leaves. So no group outgrows its budget, however frequent a word is. Words with too
    few occurrences end a suffix: a filter of fixed size says which do.

    A null language is ``und``, a null text empty; repeated rows count each; other columns are ignored; an empty table
    gives no rows. Results depend only on the rows.
    """
    importable(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    words = keep(count_words(texts), "words")
    whole = words.groupBy("lang").agg(F.sum("f").alias("n"))
    found = keep(count_phrases(texts, words, least, leaves), "phrases")
    parts = keep(found.select("lang", "phrase", "f").unionByName(words.where(F.col("f") >= least).select("lang", F.col("word").alias("phrase"), "f")), "parts")
    scored = best_cut(found, parts)
    free = scored.join(covers(found), ["lang", "phrase"], "left").where(f"top IS NULL OR cast(top AS decimal(20,0)) * {contained[1]} < cast(a AS decimal(20,0)) * {contained[0]}")
    order = [F.desc("score"), F.desc("a"), "phrase"]
    few = free.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(64))).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("place") <= most)
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).where(F.col("rank") <= most)
    return ranked.join(whole, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def best_cut(found: DataFrame, parts: DataFrame) -> DataFrame:
    """``lang, phrase, a, l, r, score`` of every phrase at its cut of lowest score."""
    cuts = found.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("m") - 1)))
    cuts = cuts.select("lang", "phrase", F.col("f").alias("a"), "k", F.expr("substring_index(phrase, ' ', k)").alias("left"), F.expr("substring_index(phrase, ' ', k - m)").alias("right"))
    left, right = (parts.select("lang", F.col("phrase").alias(side), F.col("f").alias(side[0])) for side in ("left", "right"))
    both = cuts.join(left, ["lang", "left"]).join(right, ["lang", "right"])
    score = F.expr("cast(a AS decimal(20,0)) * 2000000 div (cast(l AS decimal(20,0)) + r)")
    best = both.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("best"))
    return best.select("lang", "phrase", "a", "best.l", "best.r", "best.score")


def covers(found: DataFrame) -> DataFrame:
    """``lang, phrase, top``: occurrences of the most frequent longer phrase that holds each phrase."""
    words = F.split("phrase", " ")
    inner = F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(2), F.col("m") - 1), lambda k: F.transform(F.sequence(F.lit(1), F.col("m") - k + 1), lambda i: F.array_join(F.slice(words, i, k), " ")))))
    return found.where("m > 2").select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(F.max("f").alias("top"))
