"""Readers and writers: dated grids, JSON lines, report files, keyed stores and audit output."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gaugework.functions.dates import date_error, strict_date
from gaugework.functions.numbers import strict_number
from gaugework.plans.joins import attach, latest_per_key
from gaugework.plans.ordered import with_previous


def load_wide_series(rows: DataFrame, header: Sequence[str | None]) -> tuple[DataFrame, DataFrame]:
    """Positional text columns under ``header`` (first name ``Date``) to long series plus an issues table.

    Blank and duplicate headers are dropped with an issue. Issues of severity ``error`` (values without
    a date, malformed or duplicate dates) must be empty before the series is used.
    """
    if not header or header[0] != "Date":
        raise ValueError("the first header must be Date")
    counts = Counter(header[1:])
    cells = rows.columns
    good = [(i, h) for i, h in enumerate(header) if i and h and counts[h] == 1]
    dropped = sorted({str(h) for h in header[1:] if not h or counts[h] > 1})
    date_text = F.trim(F.coalesce(F.col(f"`{cells[0]}`"), F.lit("")))
    value_map = F.array(*[F.struct(F.lit(h).alias("series"), F.col(f"`{cells[i]}`").alias("cell")) for i, h in good])
    long = rows.select(date_text.alias("date_text"), F.explode(value_map).alias("c")).select("date_text", "c.series", "c.cell")
    dated = long.withColumn("obs_date", strict_date(F.col("date_text")))
    series = dated.where(F.col("obs_date").isNotNull()).select("series", "obs_date", strict_number(F.trim("cell")).alias("value"))
    filled = F.coalesce(F.trim("cell"), F.lit("")) != ""

    def issue(df: DataFrame, severity: str, message: Column) -> DataFrame:
        return df.select(F.lit(severity).alias("severity"), message.alias("message"))

    undated = dated.where((F.col("date_text") == "") & filled)
    malformed = dated.where(date_error(F.col("date_text"))).select("date_text").distinct()
    repeated = rows.select(strict_date(date_text).alias("d")).where("d IS NOT NULL").groupBy("d").count().where("count > 1")
    bad_number = dated.where(filled & F.col("obs_date").isNotNull() & strict_number(F.trim("cell")).isNull())
    issues = (
        issue(undated, "error", F.concat(F.lit("observation without a date in "), F.col("series")))
        .union(issue(malformed, "error", F.concat(F.lit("malformed date "), F.col("date_text"))))
        .union(issue(repeated, "error", F.concat(F.lit("duplicate date "), F.col("d").cast("string"))))
        .union(issue(bad_number, "warning", F.concat_ws(" ", F.lit("nonnumeric cell"), F.col("obs_date").cast("string"), "series", "cell")))
    )
    if dropped:
        spark = rows.sparkSession
        issues = issues.union(spark.createDataFrame([("warning", f"duplicate or blank header {h!r}") for h in dropped], "severity string, message string"))
    return series, issues


def wide_from_csv(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Read a CSV grid without trusting its header names, then :func:`load_wide_series`."""
    header = spark.read.csv(path, header=False, inferSchema=False).first()
    body = spark.read.csv(path, header=True, inferSchema=False)
    return load_wide_series(body.toDF(*[f"c{i}" for i in range(len(body.columns))]), list(header))


def read_json_lines(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """One object per line; broken lines and lines that are not objects are skipped."""
    return parse_json_lines(spark.read.text(path), schema)


def parse_json_lines(lines: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Parse a ``value`` text column; rows that do not fit the schema are dropped."""
    if isinstance(schema, str):
        schema = T._parse_datatype_string(schema)
    checked = T.StructType([*schema.fields, T.StructField("_broken", T.StringType())])
    objects = lines.where(F.trim("value").rlike(r"(?s)^\{.*\}$"))
    parsed = objects.select(F.from_json("value", checked, {"columnNameOfCorruptRecord": "_broken", "mode": "PERMISSIVE"}).alias("r"))
    return parsed.where(F.col("r").isNotNull() & F.col("r._broken").isNull()).select("r.*").drop("_broken")


def resolve_columns(df: DataFrame, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Find report columns by normalised name; an unknown layout is refused."""
    def tidy(name: str) -> str:
        return re.sub(r"[^a-z0-9]+", "_", name.lower()).strip("_")

    have = {tidy(c): c for c in df.columns}
    picked = []
    for target, names in wanted.items():
        hit = next((have[tidy(n)] for n in names if tidy(n) in have), None)
        if hit is None:
            raise ValueError(f"report layout not recognised: no column for {target} among {sorted(have)}")
        picked.append(F.col(f"`{hit}`").alias(target))
    return df.select(*picked)


def read_report(spark: SparkSession, path: str, wanted: Mapping[str, Sequence[str]]) -> DataFrame:
    """Delimited report as text columns under canonical names."""
    return resolve_columns(spark.read.csv(path, header=True, inferSchema=False), wanted)


# Record identifiers in order of preference.
ID_PRIORITY = [
    "factor_score_id", "pillar_score_id", "snapshot_id", "state_id", "change_id", "claim_id", "document_id",
    "guidance_outcome_id", "guidance_id", "commitment_id", "outcome_id", "event_id", "transaction_id",
    "cluster_id", "rights_id", "coverage_id", "committee_id", "expertise_id", "tenure_id", "board_membership_id",
    "overboarding_id", "relationship_id", "voting_control_id", "voting_class_id", "filing_id",
]


def dedupe_by_id(df: DataFrame, order: Sequence[Column | str], priority: Sequence[str] = ID_PRIORITY) -> DataFrame:
    """Last row per first non-empty identifier; rows without any identifier are all kept."""
    present = [c for c in priority if c in df.columns]
    key = F.coalesce(*[F.nullif(F.col(c).cast("string"), F.lit("")) for c in present])
    keyed = df.withColumn("_key", key)
    last = latest_per_key(keyed.where(F.col("_key").isNotNull()), ["_key"], order)
    return last.unionByName(keyed.where(F.col("_key").isNull())).drop("_key")


def upsert(stored: DataFrame, incoming: DataFrame, key: str, identity: Sequence[str], ignore: Sequence[str] = ("created_at",)) -> DataFrame:
    """New snapshot with an ``action`` per row: added, updated, unchanged, kept; replaced duplicates disappear.

    A stored row with another key but the same ``identity`` content is replaced by the incoming row
    (counted as updated). Columns in ``ignore`` do not count as a difference.
    """
    compared = [c for c in stored.columns if c not in (key, *ignore)]
    mark = F.sha2(F.to_json(F.struct(*[F.col(c) for c in compared]), {"ignoreNullFields": "false"}), 256)
    ident = F.sha2(F.to_json(F.struct(*[F.col(c) for c in identity]), {"ignoreNullFields": "false"}), 256)
    old = stored.withColumns({"_mark": mark, "_ident": ident})
    new = incoming.select(*stored.columns).withColumns({"_mark": mark, "_ident": ident})
    # One identity may be shared by many copies, so each side meets only the other side's key range, never its rows.
    bounds = lambda df, p: df.groupBy("_ident").agg(F.min(key).alias(f"_lo{p}"), F.max(key).alias(f"_hi{p}"))
    other = lambda p: (F.col(f"_lo{p}") != F.col(key)) | (F.col(f"_hi{p}") != F.col(key))
    gone = attach(old, bounds(new, "n"), ["_ident"], how="inner").where(other("n")).select(key).distinct()
    takes_over = attach(new, bounds(old, "o"), ["_ident"], how="inner").where(other("o")).select(key).distinct().withColumn("_takes", F.lit(True))
    remaining = old.join(gone, key, "left_anti")
    right = new.select(F.col(key), F.col("_mark").alias("_new_mark"), F.struct(*stored.columns).alias("_new"))
    both = remaining.select(F.col(key), F.col("_mark").alias("_old_mark"), F.struct(*stored.columns).alias("_old")).join(right, key, "full").join(takes_over, key, "left")
    action = (
        F.when(F.col("_new").isNull(), "kept")
        .when(F.col("_old").isNull(), F.when(F.col("_takes"), "updated").otherwise("added"))
        .when(F.col("_old_mark") == F.col("_new_mark"), "unchanged")
        .otherwise("updated")
    )
    row = F.when(F.col("_new").isNull() | (F.col("_old_mark") == F.col("_new_mark")), F.coalesce("_old", "_new")).otherwise(F.col("_new"))
    return both.select(action.alias("action"), row.alias("_row")).select("_row.*", "action")


def action_counts(snapshot: DataFrame) -> DataFrame:
    return snapshot.groupBy("action").agg(F.count("*").alias("rows"))


def replace_scope(stored: DataFrame, incoming: DataFrame, scope: Sequence[str]) -> DataFrame:
    """All stored rows of the scopes that arrive are replaced; other scopes stay."""
    kept = stored.join(incoming.select(*scope).distinct(), list(scope), "left_anti")
    return kept.select(*stored.columns).unionByName(incoming.select(*stored.columns))


def write_scope(df: DataFrame, folder: str, scope: str) -> None:
    """Replace only the partitions of ``scope`` present in ``df``."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(scope).parquet(folder)


def document_index(documents: DataFrame) -> DataFrame:
    """Index rows (index_name, key, document_id): one row per entry, so a hot key stays distributed."""
    entries = F.array(
        F.struct(F.lit("by_id").alias("index_name"), F.col("document_id").cast("string").alias("key")),
        F.struct(F.lit("by_ticker").alias("index_name"), F.col("ticker").cast("string").alias("key")),
        F.struct(F.lit("by_type").alias("index_name"), F.col("document_type").cast("string").alias("key")),
        F.struct(F.lit("by_period").alias("index_name"), F.coalesce(F.col("period_label").cast("string"), F.lit("unknown")).alias("key")),
    )
    return documents.select("document_id", F.explode(entries).alias("e")).select("e.index_name", "e.key", "document_id")


def content_snapshots(retrievals: DataFrame) -> DataFrame:
    """Content hash, schema fingerprint and the fields changed since the previous snapshot of that source and period.

    ``retrievals``: source, period, retrieved_at, content, schema ARRAY<STRING>, parsed MAP<STRING,STRING>.
    """
    hashed = retrievals.withColumns({
        "sha256": F.sha2("content", 256),
        "schema_fingerprint": F.sha2(F.array_join(F.array_sort("schema"), "\n"), 256),
    })
    marked = with_previous(hashed, ["source", "period"], ["retrieved_at"], ["sha256", "parsed"])
    names = F.array_sort(F.array_union(F.map_keys("parsed"), F.map_keys("prev_parsed")))
    changed = F.filter(names, lambda k: ~F.try_element_at("parsed", k).eqNullSafe(F.try_element_at("prev_parsed", k)))
    fields = F.when(F.col("prev_parsed").isNotNull(), changed)
    return marked.withColumn("changed_fields", fields).withColumn(
        "revision", F.when(F.size("changed_fields") > 0, F.concat(F.lit("Changed fields: "), F.array_join("changed_fields", ", "))).otherwise("")
    ).drop("prev_parsed")


def write_audit(scored: DataFrame, excluded: DataFrame, registry: DataFrame, folder: str) -> None:
    """Audit output: scored rows by industry (range-sorted so a large industry spans many files), the rest as tables."""
    ordered = scored.repartitionByRange("industry", F.desc("net_score"), F.desc("long_score")).sortWithinPartitions("industry", F.desc("net_score"), F.desc("long_score"))
    ordered.write.mode("overwrite").partitionBy("industry").parquet(f"{folder}/scored")
    flat = [F.to_json(c).alias(c) if isinstance(scored.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(c) for c in scored.columns]
    scored.select(*flat).write.mode("overwrite").option("header", True).csv(f"{folder}/scored_csv")
    excluded.write.mode("overwrite").parquet(f"{folder}/excluded")
    registry.write.mode("overwrite").parquet(f"{folder}/registry")


def audit_proof(scored: DataFrame, folder: str, by: str = "industry") -> DataFrame:
    """Read-back proof of the written audit: per partition the rows and content sums of the source and of the files.

    Counts and sums of row hashes are taken on both sides and joined, so a lost, doubled or changed row shows in its partition.
    """
    columns = [c for c in scored.columns if c != by]
    content = F.xxhash64(*[F.to_json(c) if isinstance(scored.schema[c].dataType, (T.ArrayType, T.MapType, T.StructType)) else F.col(c) for c in columns]).cast("decimal(38,0)")
    told = lambda df, side: df.groupBy(F.col(by).cast("string").alias(by)).agg(F.count("*").alias(f"{side}_rows"), F.sum(content).alias(f"{side}_sum"))
    back = scored.sparkSession.read.parquet(f"{folder}/scored")
    both = told(scored, "source").join(told(back, "read"), by, "full")
    return both.select(by, F.coalesce("source_rows", F.lit(0)).alias("source_rows"), F.coalesce("read_rows", F.lit(0)).alias("read_rows"), F.coalesce(F.col("source_sum") == F.col("read_sum"), F.lit(False)).alias("same_content"))
