"""Masks, de-identification, suppression and publishing guards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tarnlake.functions.columns import SMALL, is_small, mask_date, mask_text, mask_zip, whole_years

#: What a tag does to its column, for readers who are not cleared.
MASKS = {"name": mask_text, "date": mask_date, "zip": mask_zip, "point": lambda c: F.lit(None).cast("double"), "path": mask_text}


def masked_view(df: DataFrame, tags: dict[str, str], cleared: bool) -> DataFrame:
    """Tagged columns through their tag's mask; a mechanism for building views, not access control by itself."""
    return df if cleared else df.select(*[MASKS[tags[c]](F.col(c)).alias(c) if c in tags else F.col(c) for c in df.columns])


def row_scope(df: DataFrame, scopes: DataFrame, reader: str, column: str = "state") -> DataFrame:
    """Rows whose value the reader's scope names; the scope ``*`` names all."""
    own = scopes.where(F.col("reader") == reader)
    every = own.where(F.col("scope") == "*").agg((F.count("*") > 0).alias("_all"))
    named = own.select(F.col("scope").alias(column)).distinct().withColumn("_named", F.lit(True))
    return df.join(named, column, "left").crossJoin(F.broadcast(every)).where(F.col("_all") | F.col("_named")).select(*df.columns)


def deid_keys(patients: DataFrame, known: DataFrame, secret: str) -> DataFrame:
    """Keys of patients that have none yet: an id and a shift of 1 to 364 days from a keyed hash, so a rerun draws the same."""
    new = patients.select("patient_id").distinct().join(known, "patient_id", "left_anti")
    digest = F.sha2(F.concat(F.lit(secret), F.lit(":"), F.col("patient_id").cast("string")), 256)
    return new.select("patient_id", F.substring(digest, 1, 32).alias("deid_id"), (F.conv(F.substring(digest, 33, 8), 16, 10).cast("long") % 364 + 1).cast("int").alias("offset_days"))


def deid_patients(patients: DataFrame, ref: Column, group_least: int = 5, oldest: int = 89, band: int = 5) -> DataFrame:
    """Birth and death years in bands; all of them go where too few people share a combination, or for the oldest."""
    age = whole_years(F.col("birth_date"), F.coalesce("death_date", ref))
    years = lambda c: F.when(F.col("_age") <= oldest, (F.floor(F.year(c) / band) * band).cast("int"))
    rows = patients.withColumn("_age", age).withColumn("_birth", years("birth_date")).withColumn("_death", years("death_date"))
    # Counted with a map-side combine and joined back: a few hundred groups hold everyone.
    group = [F.coalesce(F.col(c).cast("string"), F.lit("none")) for c in ("_birth", "gender", "_death")]
    rows = rows.withColumn("_group", F.concat_ws("|", *group))
    rows = rows.join(rows.groupBy("_group").agg(F.count("*").alias("_people")), "_group")
    rows = rows.withColumn("hidden", (F.col("_people") < group_least) | (F.col("_age") > oldest))
    show = lambda c: F.when(~F.col("hidden"), c)
    return rows.select("patient_id", show(F.col("_birth")).alias("birth_year_from"), show(F.col("_death")).alias("death_year_from"), F.col("hidden").alias("years_suppressed"), show(F.col("death_date").isNotNull()).alias("is_deceased"), "gender", "state")


def shift_encounters(encounters: DataFrame, keys: DataFrame) -> DataFrame:
    """Times moved by the patient's own days, so gaps between visits stay exact."""
    move = F.make_dt_interval(F.col("offset_days"))
    return encounters.join(keys.select("patient_id", "offset_days"), "patient_id").select("patient_id", "encounter_id", (F.col("started_at") + move).alias("started_at"), (F.col("stopped_at") + move).alias("stopped_at"), "encounter_class")


def k_anonymity(versions: dict[str, tuple[DataFrame, list[Column]]]) -> DataFrame:
    """How many groups and people share a combination of quasi-identifiers, by size: 1 to 4, 5-10, 11+."""
    parts = []
    for name, (df, quasi) in versions.items():
        sizes = df.groupBy(*quasi).agg(F.count("*").alias("n"))
        label = F.when(F.col("n") >= 11, "11+").when(F.col("n") >= 5, "5-10").otherwise(F.col("n").cast("string"))
        parts.append(sizes.groupBy(F.lit(name).alias("version"), label.alias("k")).agg(F.count("*").alias("groups"), F.sum("n").alias("people")))
    return reduce(DataFrame.unionByName, parts)


def _side_small(stays: Column, hits: Column) -> Column:
    return (stays <= SMALL) | is_small(hits)


def small_cells(levels: DataFrame) -> DataFrame:
    """``suppressed`` where either side has few stays or a small count of hits."""
    return levels.withColumn("suppressed", _side_small(F.col("index_stays"), F.col("readmitted")) | _side_small(F.col("rest_stays"), F.col("rest_readmitted")))


def complementary(levels: DataFrame) -> DataFrame:
    """Hide more levels of a signal until the hidden ones hold none or no small count together and are not exactly one.

    The order in which further levels go ('other', then those with hits, then the fewest)
    does not depend on what is hidden so far, so running sums along it give the state after
    every step, and the first state that passes is taken: no loop.
    """
    total = levels.withColumn("_stays", F.col("index_stays") + F.col("rest_stays")).withColumn("_hits", F.col("readmitted") + F.col("rest_readmitted"))
    own = Window.partitionBy("signal")
    base = {"n": F.lit(1), "s": F.col("index_stays"), "h": F.col("readmitted")}
    rows = total.withColumns({f"_base_{k}": F.sum(F.when(F.col("suppressed"), v).otherwise(0)).over(own) for k, v in base.items()}).withColumn("_levels", F.count("*").over(own))
    pick = Window.partitionBy("signal").orderBy("suppressed", F.col("level") != "other", F.col("readmitted") == 0, "readmitted", "index_stays", "level")
    rows = rows.withColumn("_step", F.row_number().over(pick))
    upto = pick.rowsBetween(Window.unboundedPreceding, 0)
    after = {k: F.col(f"_base_{k}") + F.sum(F.when(~F.col("suppressed"), v).otherwise(0)).over(upto) for k, v in base.items()}

    def passes(n: Column, s: Column, h: Column) -> Column:
        nothing_shown = n >= F.col("_levels")
        return nothing_shown | ~((n == 1) | ((s > 0) & _side_small(s, h)))

    rows = rows.withColumn("_start", passes(*[F.col(f"_base_{k}") for k in base])).withColumn("_here", passes(*after.values()) & ~F.col("suppressed"))
    stop = F.when(F.col("_start"), 0).otherwise(F.min(F.when(F.col("_here"), F.col("_step"))).over(own))
    rows = rows.withColumn("_stop", stop)
    hidden = F.col("suppressed") | (F.col("_step") <= F.coalesce("_stop", F.lit(0)))
    return rows.withColumn("suppressed", hidden).select(*levels.columns)


def secondary(members: DataFrame, group: str, count: str, member: str) -> DataFrame:
    """Which members' counts stay hidden beside a shown total: the small ones and as few of the smallest others as the rest needs.

    With j others hidden, their sum less j times the smallest shown one must not pin down the small counts:
    the small and j others together are hidden as soon as that leaves at most one.
    """
    small = is_small(F.col(count))
    own, order = Window.partitionBy(group), Window.partitionBy(group).orderBy(small.desc(), count, member)
    rows = members.withColumn("_small", small).withColumn("_any", F.max(small).over(own)).withColumn("_j", F.sum((~small).cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("_sum", F.sum(F.when(~small, F.col(count)).otherwise(0)).over(order.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_next", F.lead(count).over(order))
    fine = ~F.col("_small") & (F.col("_next").isNull() | (F.col("_sum") - F.col("_j") * F.col("_next") <= 1))
    rows = rows.withColumn("_need", F.min(F.when(fine, F.col("_j"))).over(own))
    return rows.withColumn("hidden", F.coalesce(F.col("_any") & (F.col("_small") | (F.col("_j") <= F.col("_need"))), F.lit(False))).select(*members.columns, "hidden")


def publish_guard(df: DataFrame, roles: dict[str, str], allowed: dict[str, list[str]]) -> DataFrame:
    """``problem, rows`` of what must not be published: numeric columns without a role, small counts, unknown texts."""
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in {"long", "integer", "double", "decimal"}]
    checks = {f"no role: {c}": F.lit(True) for c in numeric if c not in roles}
    checks |= {f"small count: {c}": is_small(F.col(c)) for c, r in roles.items() if r == "count"}
    checks |= {f"unknown text: {c}": F.col(c).isNotNull() & ~F.col(c).isin(v) for c, v in allowed.items()}
    one = df.agg(*[F.count_if(v).alias(k) for k, v in checks.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("problem"), F.col(f"`{k}`").alias("rows")) for k in checks])).alias("x")).select("x.*").where("rows > 0")


def pseudonyms(members: DataFrame, name: str, rank_by: Column, label: str, keep: list[str]) -> DataFrame:
    """Names replaced by a label and their rank, except those to keep."""
    kept = F.col(name).isin(keep)
    rank = F.row_number().over(Window.partitionBy(kept).orderBy(rank_by.desc(), name))
    return members.withColumn("pseudonym", F.when(kept, F.col(name)).otherwise(F.concat(F.lit(f"{label} "), rank)))


def tag_drift(columns: DataFrame, tags: DataFrame, policies: DataFrame, pattern: str) -> DataFrame:
    """Tags without a policy, and columns named like identifiers without a tag."""
    loose = tags.join(policies, "tag", "left_anti").select(F.lit("tag without policy").alias("problem"), F.concat_ws(".", "table_name", "column_name").alias("subject"))
    bare = columns.where(F.lower("column_name").rlike(pattern)).join(tags, ["table_name", "column_name"], "left_anti")
    return loose.unionByName(bare.select(F.lit("identifier without tag").alias("problem"), F.concat_ws(".", "table_name", "column_name").alias("subject")))


#: Tagged tables that an audit takes, at most: their names go to every task.
MOST_TABLES = 100_000


def access_audit(statements: DataFrame, tables: DataFrame) -> DataFrame:
    """Statements that name a tagged table, an upper bound on reads; distinct texts meet the table names."""
    if tables.limit(MOST_TABLES + 1).count() > MOST_TABLES:
        raise ValueError(f"more than {MOST_TABLES} tagged tables")
    texts = statements.groupBy("statement").agg(F.count("*").alias("runs"))
    return texts.join(F.broadcast(tables), F.contains(F.lower("statement"), F.lower("table_name"))).groupBy("table_name").agg(F.sum("runs").alias("runs"))


def published(report: DataFrame, rounded: dict[str, int], without: set[str]) -> DataFrame:
    """A report without some of its columns and with numbers rounded."""
    return report.select(*[F.round(c, rounded[c]).alias(c) if c in rounded else F.col(c) for c in report.columns if c not in without])


def published_windows(windows: DataFrame, names: list[str], size: str, flagged: str, known: set[str]) -> DataFrame:
    """Sizes and flag rates of windows, hidden where the size or the number flagged is small; names that aren't ``known`` are refused."""
    if unknown := set(names) - known:
        raise ValueError(f"unknown names: {sorted(unknown)}")
    fine = ~(is_small(F.col(size)) | is_small(F.col(flagged)))
    return windows.select(*names, F.when(fine, F.col(size)).alias(size), F.when(fine, F.round(F.col(flagged) / F.col(size), 3)).alias("flag_rate"))


def hidden_refusals(levels: DataFrame, group: str, count: str, hidden: Column, tile: DataFrame) -> DataFrame:
    """``problem, rows``: groups whose hidden counts can be worked out from what is shown.

    Refused are a hidden level that is alone, hidden levels that sum up to 1 to 10, and a published total
    (``group, total``) that leaves 1 to 10 beside the levels shown.
    """
    per = levels.groupBy(group).agg(F.count_if(hidden).alias("alone"), F.sum(F.when(hidden, F.col(count)).otherwise(0)).alias("under"), F.sum(F.when(~hidden, F.col(count)).otherwise(0)).alias("shown")).join(tile, group)
    checks = {"lone hidden level": F.col("alone") == 1, "small hidden sum": is_small(F.col("under")), "small leftover": is_small(F.col("total") - F.col("shown"))}
    one = per.agg(*[F.count_if(v).alias(k) for k, v in checks.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("problem"), F.col(f"`{k}`").alias("rows")) for k in checks])).alias("x")).select("x.*").where("rows > 0")


def published_scores(report: DataFrame, whole: str, least: int = 30) -> DataFrame:
    """A scorer's evaluation as it may be published: ``rows, recall, average_precision, brier, verdict``.

    Numbers are rounded and shown for ``whole`` only, and not where 1 to 10 were caught or missed; other
    rows keep a verdict on whether they can be judged. Counts go.
    """
    fine = (F.col("rows") == whole) & ~is_small(F.col("caught")) & ~is_small(F.col("missed"))
    return report.select("rows", *[F.when(fine, F.round(c, 3)).alias(c) for c in ("recall", "average_precision", "brier")], F.when(F.col("hits") < least, "too few").otherwise("judged").alias("verdict"))
