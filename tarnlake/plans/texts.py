"""Queries over spans of notes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tarnlake.operators import spans as op
from tarnlake.operators.stays import number_spans
from tarnlake.plans.registry import query
from tarnlake.plans.sql_views import VIEWS
from tarnlake.sources import adapters as a

#: Fixed patterns of what may identify a person in a note.
PATTERNS = {"ssn": r"\b\d{3}-\d{2}-\d{4}\b", "date": r"\b\d{4}-\d{2}-\d{2}\b", "zip": r"\b\d{5}(?:-\d{4})?\b", "contact": r"\b[\w.+-]+@[\w-]+\.[\w.]+\b", "ip": r"\b\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}\b", "age": r"\b(9\d|1\d{2}) year-old"}


@query("SELECT note_id, CAST(i AS INT) AS chunk_index, CAST(i * 1800 AS INT) AS char_start, substr(note_text, CAST(i * 1800 + 1 AS BIGINT), 2000) AS chunk FROM (SELECT *, unnest(generate_series(0, greatest((length(note_text) - 1) // 1800, 0))) AS i FROM note)")
def tx_chunk(spark: SparkSession, d: str) -> DataFrame:
    return op.chunk_notes(a.note(spark, d), "note_id", "note_text")


def matches_sql(source: str, text: str, pattern: str, category: str, keep: str, length: str = "length(m[n])") -> str:
    """SQL of all matches with their places: what lies between matches, split at them, adds up to their starts."""
    return f"""SELECT {keep}, CAST(list_sum(list_transform(parts[:n], lambda x: length(x))) + coalesce(list_sum(list_transform(m[:n - 1], lambda x: length(x))), 0) AS INT) AS char_start,
        {length} AS size, '{category}' AS category, m[n] AS surface FROM (SELECT *, unnest(range(1, len(m) + 1)) AS n FROM (SELECT *, regexp_extract_all({text}, '{pattern}') AS m, string_split_regex({text}, '{pattern}') AS parts FROM {source}))"""


#: In ``PATTERNS`` only ages have a group, and it begins where the match does.
DETECTED = " UNION ALL ".join(
    "SELECT note_id, char_start, CAST(char_start + size AS INT) AS char_end, category, left(surface, size) AS surface FROM ("
    + matches_sql("note", "note_text", p.replace("(9", "(?:9"), k, "note_id", "length(m[n])" if k != "age" else "length(m[n]) - 9") + ")" for k, p in PATTERNS.items())


@query(DETECTED)
def tx_detect_pattern(spark: SparkSession, d: str) -> DataFrame:
    return op.detect_patterns(a.note(spark, d), PATTERNS)


@query(f"SELECT category, count(*) AS spans, count(DISTINCT note_id) AS notes, count(DISTINCT surface) AS surfaces FROM ({DETECTED}) GROUP BY category")
def udf_detect_regex(spark: SparkSession, d: str) -> DataFrame:
    """All patterns in one pass over a note."""
    found = op.detect_patterns(a.note(spark, d), PATTERNS)
    return found.groupBy("category").agg(F.count("*").alias("spans"), F.count_distinct("note_id").alias("notes"), F.count_distinct("surface").alias("surfaces"))


@query(r"SELECT note_id FROM note WHERE regexp_matches(note_text, '(^|[^0-9A-Za-z_])the($|[^0-9A-Za-z_])')")
def flt_regex_lookaround(spark: SparkSession, d: str) -> DataFrame:
    """Notes that hold a word as a whole."""
    return a.note(spark, d).where(F.col("note_text").rlike(r"(?<![0-9A-Za-z_])the(?![0-9A-Za-z_])")).select("note_id")


#: A run of letters that may be a name, and one that starts like a name; the same in every engine.
WORD, TITLED = "[a-zA-Z]{4,}", "[A-Z][a-z]{3,}"
VIEWS["needle"] = f"SELECT note_id, note_text, unnest([{{'category': 'name', 'needle': w[1]}}, {{'category': 'geography', 'needle': w[-1]}}], recursive := true) FROM (SELECT note_id, note_text, regexp_extract_all(note_text, '{WORD}') AS w FROM note) WHERE len(w) > 0"
VIEWS["truth"] = r"""SELECT DISTINCT note_id, char_start, CAST(char_start + length(needle) AS INT) AS char_end, category, needle AS surface FROM (SELECT note_id, note_text, category, needle, CAST(list_sum(list_transform(parts[:n], lambda x: length(x))) + (n - 1) * length(needle) AS INT) AS char_start
  FROM (SELECT *, unnest(range(1, len(parts))) AS n FROM (SELECT *, string_split(note_text, needle) AS parts FROM needle)))
  WHERE NOT regexp_matches(substr(note_text, char_start, CASE WHEN char_start > 0 THEN 1 ELSE 0 END), '[\pL\pN_]') AND NOT regexp_matches(substr(note_text, char_start + length(needle) + 1, 1), '[\pL\pN_]')"""


def needles(spark: SparkSession, d: str) -> DataFrame:
    """Two words of every note: the first that may be a name, and the last."""
    words = F.regexp_extract_all("note_text", F.lit(WORD), F.lit(0))
    own = a.note(spark, d).select("note_id", words.alias("w")).where(F.size("w") > 0)
    two = F.array(*[F.struct(F.lit(k).alias("category"), F.element_at("w", i).alias("needle")) for k, i in (("name", 1), ("geography", -1))])
    return own.select("note_id", F.explode(two).alias("n")).select("note_id", "n.*")


def truth(spark: SparkSession, d: str) -> DataFrame:
    return op.find_needles(a.note(spark, d), needles(spark, d))


@query("SELECT * FROM truth")
def tx_answer_key(spark: SparkSession, d: str) -> DataFrame:
    return truth(spark, d)


@query("SELECT note_id, char_start, char_end, surface FROM truth WHERE category = 'name'")
def udf_find_all(spark: SparkSession, d: str) -> DataFrame:
    return op.find_needles(a.note(spark, d), needles(spark, d).where("category = 'name'")).select("note_id", "char_start", "char_end", "surface")


GUESSES = {"name": TITLED, "zip": "[0-9]{5}"}
VIEWS["chunk"] = "SELECT note_id, CAST(i AS INT) AS chunk_index, CAST(i * 1800 AS INT) AS shift, substr(note_text, CAST(i * 1800 + 1 AS BIGINT), 2000) AS chunk FROM (SELECT *, unnest(generate_series(0, greatest((length(note_text) - 1) // 1800, 0))) AS i FROM note)"
VIEWS["token"] = " UNION ALL ".join(f"SELECT note_id, category AS kind, char_start + shift AS char_start, CAST(char_start + shift + size AS INT) AS char_end FROM ({matches_sql('chunk', 'chunk', p, k, 'note_id, shift')})" for k, p in GUESSES.items())
VIEWS["merged"] = """SELECT note_id, kind, min(char_start) AS char_start, max(char_end) AS char_end FROM (SELECT *, sum(fresh) OVER (PARTITION BY note_id, kind ORDER BY char_start, char_end ROWS UNBOUNDED PRECEDING) AS part FROM (SELECT *,
CASE WHEN char_start <= max(char_end) OVER (PARTITION BY note_id, kind ORDER BY char_start, char_end ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM token)) GROUP BY note_id, kind, part"""
VIEWS["guess"] = "SELECT 'tagger' AS stage, note_id, char_start, char_end, kind AS category FROM merged UNION ALL " + " UNION ALL ".join(f"SELECT 'pattern', note_id, char_start, CAST(char_start + size AS INT), category FROM ({matches_sql('note', 'note_text', p, k, 'note_id')})" for k, p in GUESSES.items())


def tokens(spark: SparkSession, d: str) -> DataFrame:
    """What a tagger of pieces finds, in the note's own places: pieces overlap, so some spans come twice or cut in two."""
    chunks = op.chunk_notes(a.note(spark, d), "note_id", "note_text")
    return op.detect_patterns(chunks, GUESSES, text="chunk", shift="char_start").select("note_id", F.col("category").alias("kind"), "char_start", "char_end")


def guess(spark: SparkSession, d: str) -> DataFrame:
    tagger = op.merge_tokens(tokens(spark, d)).select(F.lit("tagger").alias("stage"), "note_id", "char_start", "char_end", F.col("kind").alias("category"))
    return tagger.unionByName(op.detect_patterns(a.note(spark, d), GUESSES).select(F.lit("pattern").alias("stage"), "note_id", "char_start", "char_end", "category"))


VIEWS["hit"] = "SELECT DISTINCT g.stage, g.category, g.note_id, g.char_start AS gs, g.char_end AS ge, t.char_start AS ts, t.char_end AS te FROM guess g JOIN truth t ON t.note_id = g.note_id AND t.category = g.category AND g.char_start < t.char_end AND t.char_start < g.char_end"
VIEWS["scored"] = """SELECT g.stage, g.category, r.reals, g.guesses, coalesce(m.ok, 0) AS ok, m.hits, m.exact, m.covered FROM (SELECT stage, category, count(DISTINCT (note_id, char_start, char_end)) AS guesses FROM guess GROUP BY ALL) g
  LEFT JOIN (SELECT category, count(DISTINCT (note_id, char_start, char_end)) AS reals FROM truth GROUP BY ALL) r USING (category)
  LEFT JOIN (SELECT stage, category, count(DISTINCT (note_id, gs, ge)) AS ok, count(DISTINCT (note_id, ts, te)) AS hits, count(DISTINCT CASE WHEN gs = ts AND ge = te THEN (note_id, ts, te) END) AS exact, count(DISTINCT CASE WHEN gs <= ts AND ge >= te THEN (note_id, ts, te) END) AS covered FROM hit GROUP BY ALL) m ON m.stage = g.stage AND m.category = g.category"""


@query("""SELECT stage, category, reals, guesses, ok AS "right", round(p, 3) AS precision, round(r, 3) AS recall, round(2 * p * r / nullif(p + r, 0), 3) AS f1, round(exact::DOUBLE / reals, 3) AS exact_recall, round(covered::DOUBLE / reals, 3) AS covered_recall FROM (SELECT *, ok::DOUBLE / guesses AS p, hits::DOUBLE / reals AS r FROM scored)""")
def tx_score(spark: SparkSession, d: str) -> DataFrame:
    return op.score_spans(truth(spark, d), guess(spark, d))


@query("SELECT category, max(CASE WHEN reals IS NOT NULL THEN round(hits::DOUBLE / reals, 3) END) AS best_recall, CAST(sum(CASE WHEN reals IS NULL THEN guesses ELSE 0 END) AS BIGINT) AS false_alarms FROM scored GROUP BY category")
def tx_false_alarms(spark: SparkSession, d: str) -> DataFrame:
    s = op.score_spans(truth(spark, d), guess(spark, d))
    return s.groupBy("category").agg(F.max("recall").alias("best_recall"), F.sum(F.when(F.col("reals").isNull(), F.col("guesses")).otherwise(0)).alias("false_alarms"))


@query("SELECT g.stage, g.category, count(*) AS pairs FROM guess g JOIN truth t ON t.note_id = g.note_id AND t.category = g.category AND g.char_start < t.char_end AND t.char_start < g.char_end GROUP BY ALL")
def jn_span_overlap(spark: SparkSession, d: str) -> DataFrame:
    t = truth(spark, d).select("note_id", "category", F.col("char_start").alias("s"), F.col("char_end").alias("e"))
    return guess(spark, d).join(t, ["note_id", "category"]).where("char_start < e AND s < char_end").groupBy("stage", "category").agg(F.count("*").alias("pairs"))


@query("SELECT * FROM merged")
def tx_detect_tokens(spark: SparkSession, d: str) -> DataFrame:
    """A tagger's spans of overlapping pieces, shifted to the note's places and merged."""
    return op.merge_tokens(tokens(spark, d))


@query("""SELECT patient_id, min(a) AS first_day, max(b) AS last_day, count(*) AS courses FROM (SELECT *, sum(fresh) OVER (PARTITION BY patient_id ORDER BY a, b, description ROWS UNBOUNDED PRECEDING) AS part FROM (SELECT *,
CASE WHEN a <= max(b) OVER (PARTITION BY patient_id ORDER BY a, b, description ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS fresh FROM (SELECT patient_id, description, started_on AS a, coalesce(stopped_on, started_on) AS b FROM medication))) GROUP BY patient_id, part""")
def wn_session_merge(spark: SparkSession, d: str) -> DataFrame:
    """Courses of medication at most a day apart, as spells of a patient."""
    m = a.medication(spark, d).select("patient_id", "description", F.col("started_on").alias("a"), F.coalesce("stopped_on", "started_on").alias("b"))
    spells = number_spans(m, ["patient_id"], "a", "b", ["a", "b", "description"], "spell", gap=1)
    return spells.groupBy("patient_id", "spell").agg(F.min("a").alias("first_day"), F.max("b").alias("last_day"), F.count("*").alias("courses")).drop("spell")


#: How a tagger may name a category; fixed values.
ALIASES = {"PERSON": "name", "per": "name", "loc": "geography"}
VIEWS["reply"] = f"SELECT note_id, shift, chunk, chunk_index % 7 = 3 AS broken, unnest(list_concat(regexp_extract_all(chunk, '{TITLED}'), ['Zzyzx'])) AS t FROM chunk"
VIEWS["located"] = """SELECT note_id, shift, t, unnest(range(1, len(parts))) AS n, parts FROM (SELECT DISTINCT note_id, shift, t, string_split(chunk, t) AS parts FROM reply WHERE NOT broken)"""


def replies(spark: SparkSession, d: str) -> DataFrame:
    """A tagger's replies to pieces, as text: every seventh is cut off, and each names a word that isn't there."""
    chunks = op.chunk_notes(a.note(spark, d), "note_id", "note_text")
    names = F.concat(F.regexp_extract_all("chunk", F.lit(TITLED), F.lit(0)), F.array(F.lit("Zzyzx")))
    reply = F.to_json(F.transform(names, lambda x: F.struct(x.alias("text"), F.lit("PERSON").alias("category"))))
    return chunks.withColumn("reply", reply).withColumn("reply", F.when(F.col("chunk_index") % 7 == 3, F.expr("left(reply, length(reply) - 1)")).otherwise(F.col("reply")))


@query("SELECT status, count(*) AS texts FROM (SELECT DISTINCT note_id, shift, CASE WHEN broken THEN 'bad_json' WHEN contains(chunk, t) THEN 'ok' ELSE 'not_in_note' END AS status, CASE WHEN NOT broken THEN t END AS t FROM reply) GROUP BY status")
def udf_spans_for(spark: SparkSession, d: str) -> DataFrame:
    """What became of each text that a reply names."""
    return op.located(replies(spark, d), ALIASES).groupBy("status").agg(F.count("*").alias("texts"))


@query("SELECT DISTINCT note_id, CAST(shift + list_sum(list_transform(parts[:n], lambda x: length(x))) + (n - 1) * length(t) AS INT) AS char_start, CAST(shift + list_sum(list_transform(parts[:n], lambda x: length(x))) + n * length(t) AS INT) AS char_end, 'name' AS category FROM located")
def tx_parse_replies(spark: SparkSession, d: str) -> DataFrame:
    """Spans of the replies in the note's places, those of overlapping pieces once."""
    return op.reply_spans(replies(spark, d), ALIASES)


@query("""WITH RECURSIVE o AS (SELECT note_id, char_start, char_end, row_number() OVER (PARTITION BY note_id ORDER BY char_start, char_end DESC) AS n FROM (SELECT DISTINCT note_id, char_start, char_end FROM guess)),
w AS (SELECT note_id, char_start, char_end, n, char_end AS stop, true AS kept FROM o WHERE n = 1 UNION ALL SELECT o.note_id, o.char_start, o.char_end, o.n, CASE WHEN o.char_start >= w.stop THEN o.char_end ELSE w.stop END, o.char_start >= w.stop FROM o JOIN w ON o.note_id = w.note_id AND o.n = w.n + 1)
SELECT note_id, char_start, char_end FROM w WHERE kept""")
def wn_nonoverlap_greedy(spark: SparkSession, d: str) -> DataFrame:
    own = guess(spark, d).select("note_id", "char_start", "char_end").distinct().groupBy("note_id").agg(F.collect_list(F.struct("char_start", "char_end")).alias("s"))
    return own.select("note_id", F.explode(op.leftmost_longest(F.col("s"))).alias("x")).select("note_id", "x.*")


def _whole(source: str, needles: str) -> str:
    """SQL of all whole-word places of a note's own needles in ``source`` (``note_id, patient_id, note_text``)."""
    return f"""SELECT note_id, category, char_start, CAST(char_start + length(needle) AS INT) AS char_end, needle AS surface FROM (SELECT *, CAST(list_sum(list_transform(parts[:n], lambda x: length(x))) + (n - 1) * length(needle) AS INT) AS char_start
      FROM (SELECT *, unnest(range(1, len(parts))) AS n FROM (SELECT note_id, note_text, category, needle, string_split(note_text, needle) AS parts FROM {source} JOIN {needles} USING (patient_id) WHERE contains(note_text, needle))))
      WHERE NOT regexp_matches(substr(note_text, char_start, CASE WHEN char_start > 0 THEN 1 ELSE 0 END), '[\\pL\\pN_]') AND NOT regexp_matches(substr(note_text, char_start + length(needle) + 1, 1), '[\\pL\\pN_]')"""


def _aged(source: str) -> str:
    return f"""SELECT note_id, category, char_start, CAST(char_start + size AS INT) AS char_end, left(surface, size) AS surface FROM ({matches_sql(source, 'note_text', r'\b(?:9[0-9]|[1-9][0-9][0-9]) year-old', 'age', 'note_id', 'length(m[n]) - 9')})"""


VIEWS["private_span"] = f"SELECT * FROM ({_whole('chart', 'private')}) UNION ALL {_aged('chart')}"
VIEWS["chart_pattern"] = " UNION ALL ".join(
    "SELECT note_id, category, char_start, CAST(char_start + size AS INT) AS char_end, left(surface, size) AS surface FROM ("
    + matches_sql("chart", "note_text", p.replace("(9", "(?:9"), k, "note_id", "length(m[n])" if k != "age" else "length(m[n]) - 9") + ")" for k, p in PATTERNS.items())
VIEWS["ordered_span"] = "SELECT *, row_number() OVER (PARTITION BY note_id ORDER BY char_start, char_end DESC, category, surface) AS n FROM (SELECT * FROM private_span UNION SELECT * FROM chart_pattern)"
#: The walk that keeps the longest span at each place, and the text put together from what lies between the kept ones.
DEID_NOTE = """WITH RECURSIVE walk AS (SELECT *, char_end AS stop, true AS kept FROM ordered_span WHERE n = 1 UNION ALL SELECT o.*, CASE WHEN o.char_start >= w.stop THEN o.char_end ELSE w.stop END, o.char_start >= w.stop FROM ordered_span o JOIN walk w ON o.note_id = w.note_id AND o.n = w.n + 1),
said AS (SELECT note_id, char_start, char_end, lag(char_end, 1, 0) OVER (PARTITION BY note_id ORDER BY n) AS last_end, CASE category WHEN 'age' THEN '90+' WHEN 'date' THEN coalesce(CASE WHEN regexp_full_match(surface, '[0-9]{4}-[0-9]{2}-[0-9]{2}') THEN strftime(TRY_CAST(surface AS DATE) + CAST(note_id % 364 + 1 AS INT), '%Y-%m-%d') END, '[DATE]') ELSE '[NAME]' END AS put FROM walk WHERE kept),
glued AS (SELECT c.note_id, string_agg(substr(c.note_text, s.last_end + 1, s.char_start - s.last_end) || s.put, '' ORDER BY s.char_start) AS front, max(s.char_end) AS last_end FROM chart c JOIN said s USING (note_id) GROUP BY c.note_id)
SELECT note_id, coalesce(front, '') || substr(note_text, coalesce(last_end, 0) + 1) AS note_text FROM chart LEFT JOIN glued USING (note_id)"""


def private_spans(spark: SparkSession, d: str, notes: DataFrame) -> DataFrame:
    return op.patient_spans(notes, a.private_values(spark, d), a.private_days(spark, d))


@query("SELECT DISTINCT * FROM private_span")
def tx_patient_spans(spark: SparkSession, d: str) -> DataFrame:
    """The answer key from a patient's tables: names, places, numbers, dates in six forms, high ages."""
    return private_spans(spark, d, a.chart(spark, d)).distinct()


def deid_notes(spark: SparkSession, d: str) -> DataFrame:
    """Notes without their patient's details and without what the patterns find; dates move by the note's days."""
    notes = a.chart(spark, d)
    spans = private_spans(spark, d, notes).unionByName(op.detect_patterns(notes, PATTERNS))
    return op.redact(notes, spans, (F.col("note_id") % 364 + 1).cast("int"))


@query(DEID_NOTE)
def pv_deid_note(spark: SparkSession, d: str) -> DataFrame:
    return deid_notes(spark, d)


VIEWS["deid_note"] = DEID_NOTE
VIEWS["redacted"] = "SELECT note_id, patient_id, d.note_text FROM deid_note d JOIN chart USING (note_id)"


@query(f"""WITH was AS (SELECT category, count(*) AS found FROM (SELECT DISTINCT * FROM private_span) GROUP BY category), still AS (SELECT category, count(*) AS left_over, count(*) FILTER (WHERE category <> 'date' OR NOT regexp_full_match(surface, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')) AS unmoved FROM ({_whole('redacted', 'private')} UNION ALL {_aged('redacted')}) GROUP BY category)
SELECT category, found, coalesce(left_over, 0) AS left_over, coalesce(unmoved, 0) AS unmoved FROM was LEFT JOIN still USING (category)""")
def udf_deid_text(spark: SparkSession, d: str) -> DataFrame:
    """Per category: the answer key's spans, and how many the redacted notes still hold: none, but for days that moved onto another of the patient's."""
    notes = a.chart(spark, d)
    key = private_spans(spark, d, notes).distinct().groupBy("category").agg(F.count("*").alias("found"))
    after = private_spans(spark, d, deid_notes(spark, d).join(notes.select("note_id", "patient_id"), "note_id")).distinct()
    moved = (F.col("category") == "date") & F.col("surface").rlike(r"^\d{4}-\d{2}-\d{2}$")
    left = after.groupBy("category").agg(F.count("*").alias("left_over"), F.count_if(~moved).alias("unmoved"))
    return key.join(left, "category", "left").fillna(0, ["left_over", "unmoved"])


@query("SELECT note_id, count(*) AS spans FROM truth GROUP BY note_id")
def ag_collect(spark: SparkSession, d: str) -> DataFrame:
    g = truth(spark, d).groupBy("note_id").agg(F.sort_array(F.collect_list(F.struct("char_start", "char_end", "category"))).alias("spans"))
    return g.select("note_id", F.size("spans").cast("long").alias("spans"))


