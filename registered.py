"""The registered queries and, for each, the same result in DuckDB's SQL."""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import workload
from pairloom.functions.record import checked_lines
from pairloom.operators import conform, coverage, gaps
from pairloom.plans.coverage_report import write_coverage
from pairloom.plans.export import export_shards, export_store
from pairloom.plans.load import LoadResult, RecordsFailed, load_files, rejected_records
from pairloom.plans.running_coverage import running_coverage
from pairloom.schema import EXPORT_FIELDS, LIST_FIELDS, RECORD_FIELDS
from pairloom.session import engine_settings, written
from pairloom.sources.folders import (
    delete_file,
    glob,
    make_folder,
    path_exists,
    rename_file,
)
from pairloom.sources.pair_store import PairStore
from pairloom.streaming.ingest import load_arrivals, load_stream
from pairloom.taxonomy import TAXONOMY

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        QUERIES[name] = run
        ORACLES[name] = sql
        return run

    return register


# --- the test input in SQL -------------------------------------------------------------


def _words(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


DOMAINS, CAPABILITIES, SHAPES = (
    _words(TAXONOMY[axis]) for axis in ("domain", "capability", "task_shape")
)

PAIRS = f"""
p AS (
  SELECT doc_id, doc_id + 1 AS id, doc_id % 20 AS k,
    'task-' || lpad(CAST(doc_id AS VARCHAR), 12, '0') AS task_id,
    {DOMAINS}[doc_id % 13 + 1] AS domain,
    CASE WHEN n_chars < 500 THEN 'easy' WHEN n_chars < 2500 THEN 'medium'
         ELSE 'hard' END AS difficulty,
    {SHAPES}[(doc_id // 13) % 6 + 1] AS task_shape,
    CASE doc_id % 3
      WHEN 0 THEN [{CAPABILITIES}[doc_id % 8 + 1]]
      WHEN 1 THEN [{CAPABILITIES}[doc_id % 8 + 1], {CAPABILITIES}[(doc_id + 3) % 8 + 1]]
      ELSE [{CAPABILITIES}[doc_id % 8 + 1], {CAPABILITIES}[doc_id % 8 + 1]]
    END AS capability_tags,
    'Summarise document ' || doc_id AS user_request,
    source AS context,
    ['lang is ' || lang] AS success_criteria,
    ['read', 'write'] AS plan,
    'language ' || lang AS reasoning_summary,
    text AS final_answer,
    ['checked'] AS self_check,
    ['n_chars ' || n_chars] AS quality_notes,
    CASE WHEN doc_id % 2 = 0 THEN NULL ELSE ['doc:' || doc_id] END AS "references",
    CASE WHEN doc_id % 5 = 0 THEN NULL ELSE CAST([] AS VARCHAR[]) END AS artifacts,
    1735689600000000 + doc_id * 1000000 AS created_at
  FROM documents)"""

TAGS = "t AS (SELECT p.*, unnest(capability_tags) AS tag FROM p)"

LONG = """
long AS (
  SELECT 'total' AS axis, '' AS key, count(*) AS n FROM p
  UNION ALL SELECT 'domain', domain, count(*) FROM p GROUP BY domain
  UNION ALL SELECT 'difficulty', difficulty, count(*) FROM p GROUP BY difficulty
  UNION ALL SELECT 'task_shape', task_shape, count(*) FROM p GROUP BY task_shape
  UNION ALL SELECT 'capability', tag, count(*) FROM t GROUP BY tag
  UNION ALL SELECT 'domain_x_difficulty', domain || ':' || difficulty, count(*)
            FROM p GROUP BY domain, difficulty)"""

WITH_PAIRS = f"WITH {PAIRS}"
WITH_LONG = f"WITH {PAIRS}, {TAGS}, {LONG}"


def _axis_rows(axis: str) -> str:
    rows = [f"('{axis}', {i}, '{v}')" for i, v in enumerate(TAXONOMY[axis])]
    return ", ".join(rows)


TAXONOMY_SQL = (
    "tax(axis, ord, value) AS (VALUES "
    + ", ".join(_axis_rows(axis) for axis in TAXONOMY)
    + ")"
)


def _dimension(axis: str) -> str:
    return f"(SELECT value AS {axis}, ord AS ord_{axis} FROM tax WHERE axis = '{axis}')"


# --- coverage --------------------------------------------------------------------------


@query("total_count", f"{WITH_PAIRS} SELECT count(*) AS n FROM p")
def _total_count(spark, sf_dir):
    return coverage.total_count(workload.pairs(spark, sf_dir))


def _axis(column: str) -> None:
    sql = f"{WITH_PAIRS} SELECT {column} AS key, count(*) AS n FROM p GROUP BY {column}"

    @query(f"axis_{column}", sql)
    def run(spark, sf_dir):
        return coverage.axis_counts(workload.pairs(spark, sf_dir), column)


for _column in ("domain", "difficulty", "task_shape"):
    _axis(_column)


@query(
    "axis_capability",
    f"WITH {PAIRS}, {TAGS} SELECT tag AS key, count(*) AS n FROM t GROUP BY tag",
)
def _axis_capability(spark, sf_dir):
    return coverage.tag_counts(workload.pairs(spark, sf_dir))


@query(
    "cross_domain_difficulty",
    f"""{WITH_PAIRS} SELECT domain AS a, difficulty AS b,
    domain || ':' || difficulty AS key, count(*) AS n FROM p GROUP BY domain, difficulty""",
)
def _cross_domain_difficulty(spark, sf_dir):
    return coverage.cross_counts(workload.pairs(spark, sf_dir), "domain", "difficulty")


@query("coverage_long", f"{WITH_LONG} SELECT axis, key, n FROM long")
def _coverage_long(spark, sf_dir):
    return coverage.coverage_long(workload.pairs(spark, sf_dir))


def _map_sql(axis: str, source: str = "long") -> str:
    entry = "'\"' || key || '\":' || n"
    return (
        f"(SELECT '{{' || coalesce(string_agg({entry}, ',' ORDER BY key), '') || '}}'"
        f" FROM {source} WHERE axis = '{axis}') AS {axis}"
    )


MAPS_SQL = ", ".join(_map_sql(axis) for axis in coverage.MAP_FIELDS)


def _document_text(df: DataFrame) -> DataFrame:
    """The coverage document with its maps as JSON text."""
    document = coverage.coverage_document(df)
    maps = [F.to_json(axis).alias(axis) for axis in coverage.MAP_FIELDS]
    return document.select("total_count", *maps)


@query(
    "coverage_document",
    f"""{WITH_LONG} SELECT
    (SELECT n FROM long WHERE axis = 'total') AS total_count, {MAPS_SQL}""",
)
def _coverage_document(spark, sf_dir):
    return _document_text(workload.pairs(spark, sf_dir))


OFF_TAXONOMY_ROWS = f"""
q AS (SELECT * FROM p WHERE domain NOT IN (SELECT value FROM tax WHERE axis = 'domain')),
u AS (SELECT q.*, unnest(capability_tags) AS tag FROM q)"""


@query(
    "coverage_empty",
    f"""WITH {PAIRS}, {TAXONOMY_SQL}, {OFF_TAXONOMY_ROWS},
    {LONG.replace("FROM p", "FROM q").replace("FROM t", "FROM u")}
    SELECT (SELECT n FROM long WHERE axis = 'total') AS total_count, {MAPS_SQL}""",
)
def _coverage_empty(spark, sf_dir):
    """The document over the rows with an unknown domain, of which there are none."""
    pairs = workload.pairs(spark, sf_dir)
    return _document_text(pairs.where(~F.col("domain").isin(*TAXONOMY["domain"])))


@query(
    "coverage_sums",
    f"""{WITH_LONG} SELECT axis, CAST(sum(n) AS BIGINT) AS n FROM long GROUP BY axis""",
)
def _coverage_sums(spark, sf_dir):
    counts = coverage.coverage_long(workload.pairs(spark, sf_dir))
    return coverage.sum_over(counts, ["total", *coverage.MAP_FIELDS])


def _native_axis(name: str, table: str, column: str) -> None:
    sql = f"SELECT {column} AS key, count(*) AS n FROM {table} GROUP BY {column}"

    @query(name, sql)
    def run(spark, sf_dir):
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        return coverage.axis_counts(rows, column, allowed=rows.columns)


_native_axis("axis_orders_priority", "orders", "o_orderpriority")
_native_axis("axis_orders_status", "orders", "o_orderstatus")
_native_axis("axis_events_type", "events", "event_type")
_native_axis("axis_conversations_role", "conversations", "role")
_native_axis("axis_documents_source", "documents", "source")


def _native_cross(name: str, table: str, a: str, b: str) -> None:
    sql = f"""SELECT {a} AS a, {b} AS b, {a} || ':' || {b} AS key, count(*) AS n
    FROM {table} GROUP BY {a}, {b}"""

    @query(name, sql)
    def run(spark, sf_dir):
        rows = spark.read.parquet(f"{sf_dir}/{table}.parquet")
        return coverage.cross_counts(rows, a, b, allowed=rows.columns)


_native_cross("cross_documents_lang_source", "documents", "lang", "source")
_native_cross("cross_lineitem_flag_status", "lineitem", "l_returnflag", "l_linestatus")
_native_cross("cross_orders_status_priority", "orders", "o_orderstatus", "o_orderpriority")


# --- gaps ------------------------------------------------------------------------------


@query(
    "gap_axes",
    f"""{WITH_LONG}, {TAXONOMY_SQL}
    SELECT tax.axis, tax.ord, tax.value, coalesce(long.n, 0) AS n
    FROM tax LEFT JOIN long ON long.axis = tax.axis AND long.key = tax.value""",
)
def _gap_axes(spark, sf_dir):
    return gaps.axis_gaps(workload.pairs(spark, sf_dir))


CELLS_SQL = f"""
WITH {PAIRS}, {TAXONOMY_SQL},
c AS (SELECT domain, difficulty, count(*) AS n FROM p GROUP BY ALL),
cells AS (
  SELECT d.*, f.*, coalesce(c.n, 0) AS n
  FROM {_dimension("domain")} d CROSS JOIN {_dimension("difficulty")} f
  LEFT JOIN c ON c.domain = d.domain AND c.difficulty = f.difficulty)"""


@query(
    "gap_cells",
    f"{CELLS_SQL} SELECT domain, difficulty, ord_domain, ord_difficulty, n FROM cells",
)
def _gap_cells(spark, sf_dir):
    return gaps.cell_gaps(workload.pairs(spark, sf_dir))


@query(
    "gap_cells_all_axes",
    f"""WITH {PAIRS}, {TAGS}, {TAXONOMY_SQL},
    c AS (SELECT domain, tag AS capability, difficulty, task_shape, count(*) AS n
          FROM t GROUP BY ALL)
    SELECT d.domain, k.capability, f.difficulty, s.task_shape, coalesce(c.n, 0) AS n
    FROM {_dimension("domain")} d CROSS JOIN {_dimension("capability")} k
    CROSS JOIN {_dimension("difficulty")} f CROSS JOIN {_dimension("task_shape")} s
    LEFT JOIN c ON c.domain = d.domain AND c.capability = k.capability
      AND c.difficulty = f.difficulty AND c.task_shape = s.task_shape""",
)
def _gap_cells_all_axes(spark, sf_dir):
    axes = list(TAXONOMY)
    return gaps.cell_gaps(workload.pairs(spark, sf_dir), axes).select(*axes, "n")


@query(
    "next_targets",
    f"""{CELLS_SQL}
    SELECT row_number() OVER (ORDER BY n, ord_domain, ord_difficulty) AS rank,
      domain, difficulty, n
    FROM cells ORDER BY rank LIMIT 10""",
)
def _next_targets(spark, sf_dir):
    return gaps.next_targets(workload.pairs(spark, sf_dir), 10)


@query(
    "off_taxonomy",
    """SELECT 'domain' AS axis, source AS value, count(*) AS n
    FROM documents GROUP BY source""",
)
def _off_taxonomy(spark, sf_dir):
    """With the source in place of the domain, all values of that axis are unknown."""
    pairs = workload.pairs(spark, sf_dir).withColumn("domain", F.col("context"))
    return gaps.off_taxonomy(pairs)


# --- load ------------------------------------------------------------------------------

# What becomes of a line damaged in way k.
INSERTED = "(0, 9, 10, 11, 13, 16, 19)"
SKIPPED = "(12)"
REASONS = {
    1: ("json", "json", None),
    2: ("json", "json", None),
    3: ("field", "missing:plan", None),
    4: ("field", "type:context", None),
    5: ("field", "type:plan", 1),
    6: ("field", "type:references", None),
    7: ("enum", "enum:domain", None),
    8: ("enum", "enum:capability_tags", 1),
    14: ("field", "missing:task_id", None),
    15: ("json", "json", None),
    17: ("insert", "nul", None),
    18: ("field", "type:self_check", None),
}


def _mixed_input(spark: SparkSession, sf_dir: str) -> str:
    folder = workload.scratch_folder(spark, "lines")
    return workload.write_lines(workload.mixed_lines(spark, sf_dir), folder)


def _new_store(spark: SparkSession) -> PairStore:
    return PairStore(spark, workload.scratch_folder(spark, "store"))


def _outcomes(spark: SparkSession, result: LoadResult) -> DataFrame:
    files = result.as_frame(spark)
    return files.agg(
        *[F.sum(c).alias(c) for c in ("inserted", "skipped", "failed")],
    )


def _flat(df: DataFrame, fields: tuple[str, ...]) -> DataFrame:
    """Lists as JSON text and times as microseconds, which both engines print alike."""

    def flat(name: str) -> Column:
        if name in LIST_FIELDS:
            return F.to_json(name).alias(name)
        return F.unix_micros(name).alias(name) if name == "created_at" else F.col(name)

    return df.select(*[flat(f) for f in fields])


def _flat_sql(fields: tuple[str, ...]) -> str:
    return ", ".join(
        f'CAST(to_json("{f}") AS VARCHAR) AS "{f}"' if f in LIST_FIELDS else f
        for f in fields
    )


LOADED_SQL = f"""
{WITH_PAIRS}, loaded AS (
  SELECT * REPLACE (
    CASE k WHEN 9 THEN CAST([] AS VARCHAR[]) ELSE capability_tags END AS capability_tags,
    CASE k WHEN 10 THEN '' ELSE user_request END AS user_request)
  FROM p WHERE k IN {INSERTED})
SELECT {_flat_sql(RECORD_FIELDS)} FROM loaded"""

OUTCOMES_SQL = f"""
{WITH_PAIRS} SELECT count(*) FILTER (k IN {INSERTED}) AS inserted,
  count(*) FILTER (k IN {SKIPPED}) AS skipped,
  count(*) FILTER (k NOT IN {INSERTED} AND k NOT IN {SKIPPED}) AS failed FROM p"""


@query("load_outcomes", OUTCOMES_SQL)
def _load_outcomes(spark, sf_dir):
    return _outcomes(
        spark, load_files(spark, [_mixed_input(spark, sf_dir)], _new_store(spark))
    )


@query("load_rows", LOADED_SQL)
def _load_rows(spark, sf_dir):
    store = _new_store(spark)
    load_files(spark, [_mixed_input(spark, sf_dir)], store)
    return _flat(store.read(), RECORD_FIELDS)


def _reasons_sql(columns: str) -> str:
    rows = ", ".join(
        f"({k}, '{stage}', '{reason}', {'NULL' if at is None else at})"
        for k, (stage, reason, at) in REASONS.items()
    )
    return f"""{WITH_PAIRS}, r(k, stage, reason, element) AS (VALUES {rows})
    SELECT {columns}, count(*) AS n FROM p JOIN r ON p.k = r.k GROUP BY {columns}"""


REJECTED = ", ".join(f"({k}, '{reason}')" for k, (_, reason, _) in REASONS.items())


@query("load_reject_reasons", _reasons_sql("stage, reason, element"))
def _load_reject_reasons(spark, sf_dir):
    store = _new_store(spark)
    result = load_files(spark, [_mixed_input(spark, sf_dir)], store)
    rejects = rejected_records(spark, store, result.load_id)
    return rejects.groupBy("stage", "reason", "element").agg(F.count("*").alias("n"))


@query("line_reasons", _reasons_sql("reason"))
def _line_reasons(spark, sf_dir):
    """The record checks alone, without files or store."""
    lines = workload.mixed_lines(spark, sf_dir).select("value")
    with engine_settings(spark):
        checked = written(checked_lines(lines), workload.scratch_folder(spark, "checked"))
    rejects = checked.where("reason is not null")
    return rejects.groupBy("reason").agg(F.count("*").alias("n"))


@query(
    "reload_skips",
    f"""{WITH_PAIRS} SELECT CAST(0 AS BIGINT) AS inserted,
    count(*) FILTER (k IN {INSERTED} OR k IN {SKIPPED}) AS skipped,
    count(*) FILTER (k NOT IN {INSERTED} AND k NOT IN {SKIPPED}) AS failed FROM p""",
)
def _reload_skips(spark, sf_dir):
    folder, store = _mixed_input(spark, sf_dir), _new_store(spark)
    load_files(spark, [folder], store)
    return _outcomes(spark, load_files(spark, [folder], store))


@query("stream_load_rows", LOADED_SQL)
def _stream_load_rows(spark, sf_dir):
    store, checkpoint = _new_store(spark), workload.scratch_folder(spark, "checkpoint")
    # All files in one micro-batch, so that "first wins" goes by their names.
    folder = _mixed_input(spark, sf_dir)
    load_stream(spark, folder, store, checkpoint, max_files_per_trigger=None)
    return _flat(store.read(), RECORD_FIELDS)


def _publish(spark: SparkSession, lines: DataFrame, folder: str, name: str) -> str:
    """Put the lines into `folder` as `<name><number>`, in place of files of these names."""
    staged = workload.write_lines(lines, workload.scratch_folder(spark, "staged"))
    make_folder(spark, folder)
    for k, file in enumerate(glob(spark, f"{staged}/part-*")):
        target = f"{folder}/{name}{k:05d}.jsonl"
        if path_exists(spark, target):
            delete_file(spark, target)
        rename_file(spark, file.path, target)
    return folder


@query("load_odd_names", LOADED_SQL)
def _load_odd_names(spark, sf_dir):
    """Files whose names Spark's own readers pass over."""
    folder, store = workload.scratch_folder(spark, "odd"), _new_store(spark)
    _publish(spark, workload.mixed_lines(spark, sf_dir), folder, "_part ")
    load_files(spark, [folder], store)
    return _flat(store.read(), RECORD_FIELDS)


@query("stream_odd_names", LOADED_SQL)
def _stream_odd_names(spark, sf_dir):
    """A stream over files half of which have names that Spark's streams pass over."""
    lines, folder = workload.mixed_lines(spark, sf_dir), workload.scratch_folder(spark, "odd")
    plain = "id = 1 OR id % 2 = 0"
    _publish(spark, lines.where(plain), folder, "part ")
    _publish(spark, lines.where(f"NOT ({plain})"), folder, "_part ")
    store, checkpoint = _new_store(spark), workload.scratch_folder(spark, "checkpoint")
    load_stream(spark, folder, store, checkpoint)
    return _flat(store.read(), RECORD_FIELDS)


@query(
    "load_ids",
    f"""{WITH_PAIRS} SELECT task_id,
    row_number() OVER (ORDER BY id % 2, id) AS id FROM p""",
)
def _load_ids(spark, sf_dir):
    """Ids follow the order in which the inputs are given, not their names."""
    lines, store = workload.valid_lines(spark, sf_dir), _new_store(spark)
    first = _publish(spark, lines.where("id % 2 = 0"), workload.scratch_folder(spark, "z"), "z")
    then = _publish(spark, lines.where("id % 2 = 1"), workload.scratch_folder(spark, "a"), "a")
    load_files(spark, [first, then], store)
    return store.read().select("task_id", "id")


@query(
    "load_missing_and_repeated_inputs",
    f"""{WITH_PAIRS}, c AS (SELECT count(*) FILTER (k IN {INSERTED}) AS i,
    count(*) FILTER (k IN {SKIPPED}) AS s,
    count(*) FILTER (k NOT IN {INSERTED} AND k NOT IN {SKIPPED}) AS f FROM p)
    SELECT 'loaded' AS status, i AS inserted, i + 2 * s AS skipped, 2 * f AS failed FROM c
    UNION ALL SELECT 'missing', 0, 0, 0""",
)
def _load_missing_and_repeated_inputs(spark, sf_dir):
    folder, store = _mixed_input(spark, sf_dir), _new_store(spark)
    result = load_files(spark, [folder, f"{folder}-none", folder], store)
    sums = [F.sum(c).alias(c) for c in ("inserted", "skipped", "failed")]
    return result.as_frame(spark).groupBy("status").agg(*sums)


@query("arrivals_rewritten_files", f"{WITH_PAIRS} SELECT {_flat_sql(RECORD_FIELDS)} FROM p")
def _arrivals_rewritten_files(spark, sf_dir):
    """Files that are written again under their names, a few of them at a time."""
    lines, store = workload.valid_lines(spark, sf_dir), _new_store(spark)
    folder, log = workload.scratch_folder(spark, "in"), workload.scratch_folder(spark, "log")
    for part in (lines.where("id % 3 = 1"), lines):
        _publish(spark, part, folder, "result")
        load_arrivals(spark, folder, store, log, max_files=4)
    return _flat(store.read(), RECORD_FIELDS)


@query(
    "load_then_coverage",
    f"""{WITH_PAIRS} SELECT domain AS a, difficulty AS b,
    domain || ':' || difficulty AS key, count(*) AS n
    FROM p WHERE k IN {INSERTED} GROUP BY domain, difficulty""",
)
def _load_then_coverage(spark, sf_dir):
    store = _new_store(spark)
    load_files(spark, [_mixed_input(spark, sf_dir)], store)
    return coverage.cross_counts(store.read(), "domain", "difficulty")


LOADS = 4


def _in_parts(spark: SparkSession, lines: DataFrame, parts: int) -> list[list[str]]:
    """Lines as up to so many lists of files, all of which follow one another by id."""
    files = parts * -(-workload.files_for(lines) // parts)
    ranged = lines.repartitionByRange(files, "id").sortWithinPartitions("id")
    folder = workload.scratch_folder(spark, "parts")
    ranged.select("value").write.text(folder)
    paths = [part.path for part in glob(spark, f"{folder}/part-*")]
    cuts = [k * len(paths) // parts for k in range(parts + 1)]
    return [paths[a:b] for a, b in zip(cuts, cuts[1:]) if a < b]


@query("coverage_incremental", f"{WITH_LONG} SELECT axis, key, n FROM long")
def _coverage_incremental(spark, sf_dir):
    """Reported after several loads, each time from the batches that are new; the batches
    are compacted in between."""
    store = _new_store(spark)
    for k, part in enumerate(_in_parts(spark, workload.valid_lines(spark, sf_dir), LOADS)):
        load_files(spark, part, store)
        if k % 2:
            counts = running_coverage(store)
        if k == LOADS // 2:
            store.compact()
            store.drop_compacted()
    return counts


@query(
    "load_reject_lines",
    f"""{WITH_PAIRS}, r(k, reason) AS (VALUES {REJECTED}),
    l AS (SELECT doc_id % {LOADS} AS file, k, CAST(sum(CASE k WHEN 13 THEN 3 ELSE 1 END)
            OVER (PARTITION BY doc_id % {LOADS} ORDER BY doc_id) AS BIGINT) AS line_no FROM p)
    SELECT file, line_no, reason FROM l JOIN r ON l.k = r.k""",
)
def _load_reject_lines(spark, sf_dir):
    """Where the refused records stand, in files with lines that are blank; a large file is
    given in parts, whose lines are numbered on."""
    file = ((F.col("id") - 1) % LOADS).alias("file")
    lines = workload.mixed_lines(spark, sf_dir).select("id", file, "value")
    folder, store = workload.scratch_folder(spark, "numbered"), _new_store(spark)
    parts = max(LOADS, workload.files_for(lines))
    lines.repartitionByRange(parts, "file", "id").sortWithinPartitions("file", "id").select(
        "file", "value"
    ).write.partitionBy("file").text(folder)
    result = load_files(spark, [e.path for e in glob(spark, f"{folder}/file=*")], store)
    file = F.regexp_extract("file_path", r"/file=(\d+)/", 1).cast("long").alias("file")
    # One row per part: the lines of the parts before it.
    text = spark.read.option("lineSep", "\n").text(folder)
    counted = text.groupBy(F.col("_metadata.file_path").alias("file_path")).count()
    before = Window.partitionBy(F.regexp_extract("file_path", r"^(.*)/", 1)).orderBy(
        "file_path"
    ).rowsBetween(Window.unboundedPreceding, -1)
    starts = counted.select(
        "file_path", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("start")
    )
    line_no = (F.col("start") + F.col("line_no")).alias("line_no")
    rejects = rejected_records(spark, store, result.load_id)
    return rejects.join(F.broadcast(starts), "file_path").select(file, line_no, "reason")


@query("load_fails_the_run", OUTCOMES_SQL)
def _load_fails_the_run(spark, sf_dir):
    """A run that was asked to fail on refused records has stored the others."""
    try:
        load_files(
            spark, [_mixed_input(spark, sf_dir)], _new_store(spark), raise_on_failed=True
        )
    except RecordsFailed as error:
        return _outcomes(spark, error.result)
    raise AssertionError("no record was refused")


@query(
    "load_created_at",
    f"""{WITH_PAIRS} SELECT count(*) FILTER (k IN {INSERTED}) AS n,
    CAST(1 AS BIGINT) AS moments, true AS during_the_load FROM p""",
)
def _load_created_at(spark, sf_dir):
    """One moment for all records of a load, whatever they say of it themselves."""
    folder, store = _mixed_input(spark, sf_dir), _new_store(spark)
    before = time.time_ns() // 1000
    load_files(spark, [folder], store)
    after = time.time_ns() // 1000
    moment = F.unix_micros("created_at")
    return store.read().agg(
        F.count("*").alias("n"),
        F.count_distinct("created_at").alias("moments"),
        F.bool_and(moment.between(before, after)).alias("during_the_load"),
    )


@query("coverage_file", f"{WITH_LONG} SELECT axis, key, n FROM long")
def _coverage_file(spark, sf_dir):
    """The file as written, read back."""
    store = _new_store(spark)
    parts = _in_parts(spark, workload.valid_lines(spark, sf_dir), 2)
    load_files(spark, [path for part in parts for path in part], store)
    path = f"{workload.scratch_folder(spark, 'report')}/coverage.json"
    write_coverage(spark, store, path)
    maps = [f"{axis} map<string,long>" for axis in coverage.MAP_FIELDS]
    schema = ", ".join(["total_count long", *maps])
    read = spark.read.schema(schema).option("multiLine", True).json(path)
    total = [F.lit("total").alias("axis"), F.lit("").alias("key")]
    rows = read.select(*total, F.col("total_count").alias("n"))
    for axis in coverage.MAP_FIELDS:
        rows = rows.unionByName(
            read.select(F.lit(axis).alias("axis"), F.explode(axis).alias("key", "n"))
        )
    return rows


# --- export ----------------------------------------------------------------------------

SHARDS = 7
SMALL_LOADS = 10


def _shard_size(rows: DataFrame) -> int:
    return -(-rows.count() // SHARDS)


def _export(spark: SparkSession, rows: DataFrame, size: int, codec: str) -> str:
    folder = workload.scratch_folder(spark, "export")
    export_shards(rows, folder, size, codec)
    return folder


def _read_shards(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/train-*.parquet")


def _shard_table(shards: DataFrame) -> DataFrame:
    number = F.regexp_extract("_metadata.file_name", r"train-(\d+)-of-", 1).cast("long")
    count = F.regexp_extract("_metadata.file_name", r"-of-(\d+)\.", 1).cast("long")
    return (
        shards.select("task_id", number.alias("shard"), count.alias("shards"))
        .groupBy("shard", "shards")
        .agg(
            F.count("*").alias("rows"),
            F.min("task_id").alias("first_task"),
            F.max("task_id").alias("last_task"),
        )
    )


SHARDS_SQL = f"""
{WITH_PAIRS}, s AS (SELECT CAST(ceil(count(*) / {SHARDS}) AS BIGINT) AS size FROM p),
i AS (SELECT task_id, size, (row_number() OVER (ORDER BY id) - 1) // size AS shard,
        CAST(ceil(count(*) OVER () / size) AS BIGINT) AS shards FROM p, s)
SELECT shard, shards, count(*) AS rows, min(task_id) AS first_task, max(task_id) AS last_task
FROM i GROUP BY shard, shards"""


@query("export_rows", f"{WITH_PAIRS} SELECT {_flat_sql(EXPORT_FIELDS)} FROM p")
def _export_rows(spark, sf_dir):
    pairs = workload.pairs(spark, sf_dir)
    folder = _export(spark, pairs, _shard_size(pairs), "zstd")
    return _flat(_read_shards(spark, folder), EXPORT_FIELDS)


@query("export_shards", SHARDS_SQL)
def _export_shards(spark, sf_dir):
    pairs = workload.pairs(spark, sf_dir)
    folder = _export(spark, pairs, _shard_size(pairs), "snappy")
    return _shard_table(_read_shards(spark, folder))


@query("export_shards_sparse_ids", SHARDS_SQL)
def _export_shards_sparse_ids(spark, sf_dir):
    """The same shards when the ids have gaps of different widths."""
    pairs = workload.pairs(spark, sf_dir)
    sparse = pairs.withColumn("id", F.expr("id * 1000 + length(final_answer) % 1000"))
    folder = _export(spark, sparse, _shard_size(pairs), "gzip")
    return _shard_table(_read_shards(spark, folder))


@query("export_shards_far_id", SHARDS_SQL)
def _export_shards_far_id(spark, sf_dir):
    """The same shards when one id lies far off all others."""
    pairs = workload.pairs(spark, sf_dir)
    last = pairs.agg(F.max("id")).first()[0]
    far = F.when(F.col("id") == last, F.lit(2**60)).otherwise(F.col("id"))
    folder = _export(spark, pairs.withColumn("id", far), _shard_size(pairs), "snappy")
    return _shard_table(_read_shards(spark, folder))


@query("export_small_loads_compacted", SHARDS_SQL)
def _export_small_loads_compacted(spark, sf_dir):
    """Many small loads, one of them given again, joined to few batches and exported."""
    store, lines = _new_store(spark), workload.valid_lines(spark, sf_dir)
    parts = _in_parts(spark, lines, SMALL_LOADS)
    for part in [*parts, parts[0]]:
        load_files(spark, part, store)
    rows = store.read().count()
    store.compact(most_rows=rows // 3)
    store.drop_compacted()
    folder = workload.scratch_folder(spark, "export")
    export_store(store, folder, -(-rows // SHARDS), "zstd")
    return _shard_table(_read_shards(spark, folder))


@query("export_twice", SHARDS_SQL)
def _export_twice(spark, sf_dir):
    """Shards of an earlier export, more of them and other ones, are replaced."""
    pairs = workload.pairs(spark, sf_dir)
    folder, size = workload.scratch_folder(spark, "export"), _shard_size(pairs)
    export_shards(pairs.where("id % 3 = 0"), folder, max(1, size // 9), "none")
    export_shards(pairs, folder, size, "snappy")
    return _shard_table(_read_shards(spark, folder))


@query("load_then_export", LOADED_SQL)
def _load_then_export(spark, sf_dir):
    store = _new_store(spark)
    result = load_files(spark, [_mixed_input(spark, sf_dir)], store)
    folder = workload.scratch_folder(spark, "export")
    export_store(store, folder, -(-result.inserted // SHARDS), "none")
    return _flat(_read_shards(spark, folder), RECORD_FIELDS)


# --- strict report ---------------------------------------------------------------------

VIOLATIONS = {
    1: [("", "json")],
    2: [("", "json")],
    3: [("plan", "required")],
    4: [("context", "type")],
    5: [("plan", "items.type")],
    6: [("references", "type")],
    7: [("domain", "enum")],
    8: [("capability_tags", "items.enum")],
    9: [("capability_tags", "minItems")],
    10: [("user_request", "minLength")],
    11: [("extra", "additionalProperties"), ("created_at", "additionalProperties")],
    14: [("", "type")],
    15: [("", "type")],
    18: [("self_check", "type")],
}
VIOLATIONS_SQL = ", ".join(
    f"({k}, '{field}', '{rule}')" for k, rows in VIOLATIONS.items() for field, rule in rows
)


@query(
    "conform_violations",
    f"""{WITH_PAIRS}, v(k, field, rule) AS (VALUES {VIOLATIONS_SQL})
    SELECT id, CASE WHEN field = '' THEN NULL ELSE task_id END AS task_id, field, rule
    FROM p JOIN v ON p.k = v.k""",
)
def _conform_violations(spark, sf_dir):
    lines = workload.mixed_lines(spark, sf_dir)
    with engine_settings(spark):
        stored = written(lines, workload.scratch_folder(spark, "mixed"))
        found = conform.strict_violations(stored)
        return written(found, workload.scratch_folder(spark, "violations"))


@query(
    "task_id_format",
    """WITH e AS (
      SELECT event_type, 'event-' || strftime(ts, '%Y%m%d') || '-'
        || lpad(CAST(event_id % 30 AS VARCHAR), 2, '0') || strftime(ts, '%M%S') AS task_id
      FROM events)
    SELECT event_type, regexp_full_match(task_id, '.+-[0-9]{8}-[0-9]{6}')
        AND try_strptime(right(task_id, 15), '%Y%m%d-%H%M%S') IS NOT NULL AS conforms,
      count(*) AS n
    FROM e GROUP BY ALL""",
)
def _task_id_format(spark, sf_dir):
    """Ids made of event times, some of them with an hour that does not exist."""
    hour = F.lpad((F.col("event_id") % 30).cast("string"), 2, "0")
    task_id = F.concat(
        F.lit("event-"),
        F.date_format("ts", "yyyyMMdd"),
        F.lit("-"),
        hour,
        F.date_format("ts", "mmss"),
    )
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    found = events.groupBy(
        "event_type", conform.has_timestamp_id(task_id).alias("conforms")
    ).agg(F.count("*").alias("n"))
    with engine_settings(spark):
        return written(found, workload.scratch_folder(spark, "ids"))
