"""End-to-end batch run: raw envelopes -> landing -> bronze -> silver -> validation report.

A batch writes all its layers under one build id, each layer read back by the next from that build's
folder, and publishes them with one commit at the end (see :mod:`pubspark.sources.lake`). Lineage is cut
at each layer, a lost executor costs tasks of the current stage, and a batch that dies before the
commit changes nothing that readers see.
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pubspark.operators.parse import NESTED_LISTS, bronze_with_status
from pubspark.operators.silver import build_silver, silver_publications, silver_quality_issues
from pubspark.operators.validation import failed_checks, validation_report
from pubspark.schemas import BRONZE_SCHEMA
from pubspark.sources.lake import (
    commit,
    entries_of,
    live_runs,
    new_build,
    read_build,
    read_layer,
    read_log,
    write_build,
)
from pubspark.sources.raw import (
    BROKEN,
    ITEM,
    KINDS,
    LANDED,
    LANDED_SCHEMA,
    as_items,
    broken_runs,
    landed_runs,
    read_broken_envelopes,
    read_envelopes,
    read_landed_build,
    read_landed_items,
    write_landing,
)

_log = logging.getLogger(__name__)

SILVER_TABLES = ("publications", "publication_authors", "identifiers", "quality_issues")
BRONZE = "bronze/works"
REPORT = "silver/validation_report"
LANDINGS = tuple(f"{LANDED}/{k}" for k in KINDS)
DERIVED = (BRONZE, *(f"silver/{t}" for t in SILVER_TABLES), REPORT)
#: Folders of the lake and the names under which their runs are logged (for ``vacuum``).
LAYERS = {LANDED: LANDINGS, **{layer: (layer,) for layer in DERIVED}}
_BY = ("run", "day")


def bronze_schema() -> T.StructType:
    return T.StructType(BRONZE_SCHEMA.fields + [T.StructField("record_hash", T.LongType()),
                                                T.StructField("source_file", T.StringType()),
                                                T.StructField("parse_ok", T.BooleanType()),
                                                T.StructField("bad_item", T.StringType()),
                                                T.StructField("run", T.StringType()),
                                                *(T.StructField(n, T.VariantType()) for n in NESTED_LISTS)])


_REPORT_SCHEMA = T.StructType([T.StructField("checked_at", T.TimestampType()), *(
    T.StructField(c, T.StringType()) for c in ("check_name", "status", "metric_value", "details", "run"))])


def silver_schemas(spark: SparkSession) -> dict[str, T.StructType]:
    """Schemas of the silver tables with ``run``, from the plan over an empty bronze (analysis only)."""
    empty = spark.createDataFrame([], bronze_schema())
    return {name: df.schema for name, df in build_silver(empty, by=("run",)).items()}


def _sound(bronze: DataFrame) -> DataFrame:
    return bronze.where("parse_ok").drop("parse_ok", "bad_item")


def read_bronze(spark: SparkSession, out_root: str, run=None, log: DataFrame | None = None) -> DataFrame:
    """Bronze works of all runs (the items that parsed), with ``run`` and ``day``."""
    return _sound(read_layer(spark, out_root, BRONZE, bronze_schema(), run, log=log))


def read_silver(spark: SparkSession, out_root: str, table: str, run="latest", log: DataFrame | None = None) -> DataFrame:
    """A silver table: of the latest validated run, of all runs (``None``), or of given ones. The
    report names every run, also one that has no rows in this table."""
    log = read_log(spark, out_root) if log is None else log
    return read_layer(spark, out_root, f"silver/{table}", silver_schemas(spark)[table], run, log=log)


def read_report(spark: SparkSession, out_root: str, run=None) -> DataFrame:
    """Validation reports of all runs (or one, or ``latest``)."""
    return read_layer(spark, out_root, REPORT, _REPORT_SCHEMA, run)


def quarantine(spark: SparkSession, out_root: str) -> DataFrame:
    """What was not processed: ``run, source_file, kind`` (``item`` or ``envelope``) and ``content``."""
    log = read_log(spark, out_root)
    written = read_layer(spark, out_root, BRONZE, bronze_schema(), None, log=log)
    items = written.where(~F.col("parse_ok")).select(
        "run", "source_file", F.lit("item").alias("kind"), F.col("bad_item").alias("content"))
    broken = read_broken_envelopes(spark, out_root, None, log)
    return items.unionByName(broken.select("run", "source_file", F.lit("envelope").alias("kind"),
                                           F.col("broken").alias("content")))


def write_bronze(items: DataFrame, out_root: str, build: str) -> None:
    """Parse items into bronze, one narrow stage. Items that do not parse are rows too
    (``parse_ok`` false, their text in ``bad_item``)."""
    write_build(bronze_with_status(items, keep=("source_file", *_BY), nested=NESTED_LISTS), out_root, BRONZE, build)


def write_silver(bronze: DataFrame, out_root: str, build: str, as_of=None) -> None:
    """Build the four silver tables of these bronze rows in one pass, keyed by run."""
    spark = bronze.sparkSession
    tables = build_silver(bronze, as_of, by=_BY)
    # publications and quality issues come out of a (run, doi) shuffle; authors and identifiers
    # are narrow from bronze and keep its file layout. Tasks with rows of one day write a file each, as
    # adaptive execution groups them; only those with several need another shuffle.
    several_days = bronze.select("day").distinct().limit(2).count() > 1
    shuffled = {"publications", "quality_issues"} if several_days else set()
    for name in SILVER_TABLES:  # quality issues last: they read the written authors
        if name == "quality_issues":
            authors = read_build(spark, out_root, "silver/publication_authors", build, tables["publication_authors"].schema)
            tables[name] = silver_quality_issues(bronze, as_of, _BY, authors)
        write_build(tables[name], out_root, f"silver/{name}", build, rebalance=name in shuffled)


def write_report(tables: dict[str, DataFrame], runs: DataFrame, out_root: str, build: str) -> None:
    """One report for each of the runs (ten rows each), in one job."""
    report = validation_report(*(tables[t] for t in SILVER_TABLES), by=_BY, groups=runs)
    write_build(report, out_root, REPORT, build, rebalance=True)


def run_bronze(spark: SparkSession, out_root: str, hold_broken: bool = True) -> str:
    """Rebuild bronze of all landed runs and publish it; runs with a broken envelope keep what they
    have, unless their sound envelopes shall do (``hold_broken=False``)."""
    log, build = read_log(spark, out_root), new_build()
    write_bronze(read_landed_items(spark, out_root, None, log, hold_broken), out_root, build)
    runs = live_runs(spark, out_root, f"{LANDED}/{ITEM}", log).select("run", "day").distinct()
    if hold_broken:
        runs = runs.join(broken_runs(spark, out_root, log), "run", "left_anti")
    commit(entries_of(runs, build, [BRONZE]), out_root)
    return build


def run_silver(spark: SparkSession, out_root: str, as_of=None) -> str:
    """Rebuild the four silver tables of all runs of bronze and publish them together."""
    log, build = read_log(spark, out_root), new_build()
    write_silver(read_bronze(spark, out_root, None, log), out_root, build, as_of)
    runs = live_runs(spark, out_root, BRONZE, log).select("run", "day").distinct()
    commit(entries_of(runs, build, [f"silver/{t}" for t in SILVER_TABLES]), out_root)
    return build


def run_validation(spark: SparkSession, out_root: str) -> str:
    """Validate all runs of silver and publish the report."""
    log, build = read_log(spark, out_root), new_build()
    runs = live_runs(spark, out_root, "silver/publications", log)
    write_report({t: read_silver(spark, out_root, t, None, log) for t in SILVER_TABLES}, runs, out_root, build)
    commit(entries_of(runs, build, [REPORT]), out_root)
    return build


def current_publications(spark: SparkSession, out_root: str) -> DataFrame:
    """Publications de-duplicated across all runs: bronze of every run (multi-run scan), latest
    deposited/indexed version per DOI, whichever run it came from."""
    return silver_publications(read_bronze(spark, out_root).drop("run", "day"))


def process(envelopes: DataFrame, out_root: str, as_of=None, day=None, partitions: int | None = None,
            keep_other_files: bool = False, silver: bool = True) -> dict:
    """Land envelopes, derive the layers of their runs and publish all with one commit.

    The landing is the only read of the envelopes: which runs are broken is decided from what was
    written. Such a run keeps what it had in the derived layers; its landing and quarantine are
    published. ``keep_other_files``: landed rows of the same runs from files that this batch does not
    bring stay (files of a run that arrive one after another); otherwise a run is replaced whole.
    Without ``silver`` only bronze follows; files that are new are then added to their runs, whose
    earlier files are neither read nor parsed again.
    """
    spark, build = envelopes.sparkSession, new_build()
    if keep_other_files:
        envelopes = envelopes.where(F.col("run").isNotNull())  # without a run there are no others to keep
    write_landing(envelopes, out_root, build, day, partitions)
    adds = keep_other_files and not silver and _only_adds(spark, out_root, build)
    if keep_other_files and not adds:
        build = _with_other_files(spark, out_root, build)
    landed = read_landed_build(spark, out_root, build)
    runs = landed_runs(spark, out_root, build)
    broken = landed.where(F.col("kind") == BROKEN).select("run").distinct()
    if adds:
        broken = broken.unionByName(broken_runs(spark, out_root)).distinct()
    sound = runs.join(broken, "run", "left_anti")
    entries = entries_of(runs, build, LANDINGS)
    derived = DERIVED if silver else (BRONZE,)
    some = not sound.isEmpty()
    if some:
        items = as_items(landed.where(F.col("kind") == ITEM).join(broken, "run", "left_anti"))
        write_bronze(items, out_root, build)
        if silver:
            write_silver(_sound(read_build(spark, out_root, BRONZE, build, bronze_schema())), out_root, build, as_of)
            schemas = silver_schemas(spark)
            write_report({t: read_build(spark, out_root, f"silver/{t}", build, schemas[t]) for t in SILVER_TABLES},
                         sound, out_root, build)
        entries = entries.unionByName(entries_of(sound, build, derived))
    number = commit(entries, out_root, adds)
    return {"build": build, "commit": number, "runs": sound, "kept_back": runs.join(broken, "run", "left_semi"),
            "report": read_build(spark, out_root, REPORT, build, _REPORT_SCHEMA) if some and silver else None}


def _only_adds(spark: SparkSession, out_root: str, build: str) -> bool:
    """Whether a landing brings nothing that its runs have: none of its files, the same day, and all that
    was landed of them (broken runs apart) is in bronze build by build."""
    log = read_log(spark, out_root)
    files = read_landed_build(spark, out_root, build).select("run", "source_file").distinct()
    runs = landed_runs(spark, out_root, build)
    had = live_runs(spark, out_root, f"{LANDED}/{ITEM}", log).join(runs.withColumnRenamed("day", "today"), "run")
    behind = had.join(broken_runs(spark, out_root, log), "run", "left_anti").join(
        live_runs(spark, out_root, BRONZE, log).select("run", "build"), ["run", "build"], "left_anti")
    against = had.where("day <> today").select("run").unionByName(behind.select("run"))
    for kind in KINDS:
        old = read_layer(spark, out_root, LANDED, LANDED_SCHEMA, runs, kind, log)
        against = against.unionByName(old.join(files, ["run", "source_file"], "left_semi").select("run"))
    return against.isEmpty()


def _with_other_files(spark: SparkSession, out_root: str, build: str) -> str:
    """A landing of the build's rows and, beside them, the live ones of its runs from other files."""
    log, whole = read_log(spark, out_root), new_build()
    new = read_landed_build(spark, out_root, build)
    runs, files = new.select("run").distinct(), new.select("run", "source_file").distinct()
    rows = new
    for kind in KINDS:
        old = read_layer(spark, out_root, LANDED, LANDED_SCHEMA, runs, kind, log)
        rows = rows.unionByName(old.join(files, ["run", "source_file"], "left_anti").withColumn("kind", F.lit(kind)))
    # A run has one day, so that one entry finds all its rows.
    days = new.groupBy("run").agg(F.max("day").alias("day"))
    write_build(rows.drop("day").join(days, "run"), out_root, LANDED, whole, keys=("kind", "day"))
    return whole


def run_pipeline(spark: SparkSession, raw_path: str, out_root: str, as_of=None,
                 raise_on_fail: bool = False, raise_on_broken: bool = False,
                 partitions: int | None = None, multi_line: bool = True) -> dict:
    """Process every raw envelope file under ``raw_path`` (one run per file) in one pass per layer.

    A run with a broken envelope keeps its earlier data in the derived layers; the broken text goes
    to the quarantine (``raise_on_broken``: raises after publishing it). Returns DataFrames of the
    processed runs, the runs kept back, all runs and the failed checks, and their numbers.
    """
    done = process(read_envelopes(spark, raw_path, multi_line=multi_line), out_root, as_of, partitions=partitions)
    kept_back = done["kept_back"].count()
    if kept_back:
        if raise_on_broken:
            raise ValueError(f"broken envelopes in {kept_back} runs, see the quarantine")
        _log.warning("broken envelopes, %d runs kept back (see the quarantine)", kept_back)
    failed, n = None, 0
    if done["report"] is not None:
        failed = failed_checks(done["report"]).select("run", "check_name", "metric_value")
        n = failed.count()
    if n:
        if raise_on_fail:
            raise AssertionError(f"silver validation failed: {n} checks, see the validation report")
        _log.warning("silver validation completed with %d failed checks, see the validation report", n)
    return {**done, "run_count": done["runs"].count(), "kept_back_count": kept_back,
            "failed_checks": failed, "failed_count": n,
            "all_runs": live_runs(spark, out_root, f"{LANDED}/{ITEM}").select("run").distinct()}
