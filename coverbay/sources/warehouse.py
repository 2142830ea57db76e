"""The star schema as versioned Parquet tables, published only when all nine tables pass.

A load writes a new version directory, checks what it wrote, computes the semantic views once, and
then creates the marker that publishes it. Readers take the newest published version, so a load that
fails or is cut short is never seen, and a repeated load replaces the whole data set. Dashboards read
the written views, whose size is segments x periods, and never the facts.

A load claims its version number first, by creating a file that only one load can create, so two
loads at a time write different folders. The claim is a lease: a load writes the file anew after each
step. A load that ends after a later version was published, or whose claim is gone, raises
:class:`LateLoad` and publishes nothing. Of the published versions the newest few are kept, older ones go
with their markers, and with them what crashed loads left behind once their lease has run out. What a
running load writes stays, whatever its number. All times are the file system's own.

    <root>/claims/<n>                       the load that may write version n, as old as its last step
    <root>/versions/<n>/raw_report          rules of the raw stage and their outcome, if there was one
    <root>/versions/<n>/<table>             the tables of one load
    <root>/versions/<n>/policy_risks        policies with the columns of their header, joined once
    <root>/versions/<n>/risk_states         the risk view's sums and numbers of scores, which add up
    <root>/versions/<n>/views/<view>        the semantic views over them, partitioned by year
    <root>/versions/<n>/manifest            name, columns and rows of each table and view
    <root>/versions/<n>/quality_report      every rule and its outcome
    <root>/published/<n>                    version n is complete
"""

from __future__ import annotations

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F

from coverbay.operators import quality
from coverbay.plans.views import POLICY_RISKS, build_views, policy_risks, risk_states
from coverbay.schemas import STAR, VIEWS
from coverbay.sources import folders

# The policy fact is the one large table that is read by year.
PARTITIONED = {"fact_policies": "policy_year"}
KEPT_VERSIONS = 3
#: A load without a finished step for so long has crashed.
LEASE_MS = 12 * 3600 * 1000
# Rows are sorted inside each file, so that row groups outside a date range are skipped.
SORTED = {"fact_policies": "effective_date_key", "fact_claims": "incident_date_key"}


class NothingPublished(Exception):
    """The warehouse has no published version."""


class LateLoad(Exception):
    """A load that ends after a later version was published, or after its claim was given up."""


def published_versions(spark: SparkSession, root: str) -> list[int]:
    """All published versions that are kept, the newest last."""
    return sorted(int(name) for name in folders.names(spark, f"{root}/published"))


def published_version(spark: SparkSession, root: str) -> int:
    """Newest published version, 0 if there is none."""
    return max(published_versions(spark, root), default=0)


def table_path(root: str, version: int, name: str) -> str:
    return f"{root}/versions/{version}/{name}"


def write_table(df: DataFrame, path: str, name: str) -> None:
    """One table in its load order and types.

    A partitioned table is rebalanced by its partition column first: adaptive execution merges
    small partitions and splits a large one, so a year with a third of all rows becomes many
    files and a small year one file.
    """
    ordered = df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in STAR[name]])
    partition, within = PARTITIONED.get(name), SORTED.get(name)
    if partition is not None:
        ordered = ordered.hint("rebalance", F.col(partition))
    if within is not None:
        ordered = ordered.sortWithinPartitions(*filter(None, [partition, within]))
    writer = ordered.write.mode("overwrite")
    if partition is not None:
        writer = writer.partitionBy(partition)
    writer.parquet(path)


def read_version(spark: SparkSession, root: str, version: int) -> dict[str, DataFrame]:
    """The nine tables of a version, and the policies joined to their headers if they are stored."""
    tables = {
        name: spark.read.schema(schema).parquet(table_path(root, version, name)).select(schema.names)
        for name, schema in STAR.items()
    }
    joined = table_path(root, version, POLICY_RISKS)
    return tables | ({POLICY_RISKS: spark.read.parquet(joined)} if folders.names(spark, joined) else {})


def read_risk_states(spark: SparkSession, root: str) -> DataFrame:
    """The risk view of the newest published version as sums and numbers of scores."""
    return spark.read.parquet(table_path(root, _published(spark, root), "risk_states"))


def _published(spark: SparkSession, root: str) -> int:
    version = published_version(spark, root)
    if version == 0:
        raise NothingPublished(root)
    return version


def read_warehouse(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The nine tables of the newest published version."""
    return read_version(spark, root, _published(spark, root))


def quality_report(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The rules of a load and their outcome, published or not."""
    return spark.read.parquet(table_path(root, version, "quality_report"))


def raw_report(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The rules of the raw stage before a load and their outcome, published or not."""
    return spark.read.parquet(table_path(root, version, "raw_report"))


def read_view(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One semantic view of the newest published version, as it was computed by the load.

    A filter on ``year`` reads that year's files only.
    """
    return _stored_view(spark, root, _published(spark, root), name)


def _stored_view(spark: SparkSession, root: str, version: int, name: str) -> DataFrame:
    view = spark.read.parquet(view_path(root, version, name))
    first, *rest = [column for column in view.columns if column != "year"]
    return view.select(first, "year", *rest)  # partition columns are read last


def view_path(root: str, version: int, name: str) -> str:
    return table_path(root, version, f"views/{name}")


def _record(spark: SparkSession, root: str, version: int, report: DataFrame, mode: str) -> None:
    """Keep the outcome of some rules, and raise if a FAIL rule is among the violated ones."""
    path = table_path(root, version, "quality_report")
    report.coalesce(1).write.mode(mode).parquet(path)
    quality.enforce(quality_report(spark, root, version))


def claim_version(spark: SparkSession, root: str) -> int:
    """The next version number that no other load holds, now held by the caller."""
    version = published_version(spark, root) + 1
    while not folders.create_once(spark, f"{root}/claims/{version}"):
        version += 1
    return version


def release_version(spark: SparkSession, root: str, version: int) -> None:
    """Give up a claimed version, so that the next load overwrites it."""
    folders.delete(spark, f"{root}/claims/{version}")


def renew_claim(spark: SparkSession, root: str, version: int) -> None:
    """Start the lease of a running load anew."""
    claim = f"{root}/claims/{version}"
    if folders.modified(spark, claim) is None:
        raise LateLoad(f"the claim of version {version} is gone")
    folders.touch(spark, claim)


def publish(spark: SparkSession, root: str, version: int) -> None:
    """Make a complete version visible, unless a later one is."""
    renew_claim(spark, root, version)
    newest = published_version(spark, root)
    if newest > version:
        raise LateLoad(f"version {newest} was published before version {version} was complete")
    folders.create_once(spark, f"{root}/published/{version}")


def drop_old_versions(spark: SparkSession, root: str, keep: int, lease_ms: int = LEASE_MS) -> None:
    """Remove published versions but the newest ``keep``, and older leftovers of loads that have ended.

    A version that isn't published stays while its claim is younger than the lease.
    """
    published = published_versions(spark, root)
    if not published:
        return
    oldest = published[-keep:][0]
    clock = f"{root}/clock"
    folders.touch(spark, clock)
    now = folders.modified(spark, clock)
    claimed = {int(name) for name in folders.names(spark, f"{root}/claims")}
    for version in sorted(claimed | {int(name) for name in folders.names(spark, f"{root}/versions")}):
        if version >= oldest:
            continue
        written = folders.modified(spark, f"{root}/claims/{version}")
        if version in published or written is None or now - written > lease_ms:
            folders.delete(spark, f"{root}/published/{version}")
            folders.delete(spark, f"{root}/versions/{version}")
            folders.delete(spark, f"{root}/claims/{version}")


def load_warehouse(
    spark: SparkSession, star: dict[str, DataFrame], root: str, version: int | None = None, keep: int = KEPT_VERSIONS
) -> int:
    """Full refresh of all nine tables and four views; returns the version it published.

    Tables are written dimensions first, then every rule runs on what was written. Raises, and
    publishes nothing, if a FAIL rule is violated; the report stays beside the tables, and the next
    load overwrites them. Raises :class:`LateLoad` if a later version is published already.
    ``version`` is one that the caller has claimed.
    """
    version = claim_version(spark, root) if version is None else version
    try:
        _write_version(spark, star, root, version)
        publish(spark, root, version)
    except BaseException:
        release_version(spark, root, version)
        raise
    drop_old_versions(spark, root, keep)
    return version


def _write_version(spark: SparkSession, star: dict[str, DataFrame], root: str, version: int) -> None:
    for name in STAR:
        write_table(star[name], table_path(root, version, name), name)
        renew_claim(spark, root, version)
    written = read_version(spark, root, version)
    _record(spark, root, version, quality.check_tables(spark, written), "overwrite")

    joined = policy_risks(written).hint("rebalance", F.col("policy_year")).sortWithinPartitions("policy_year", "effective_date_key")
    joined.write.mode("overwrite").partitionBy("policy_year").parquet(table_path(root, version, POLICY_RISKS))
    written = read_version(spark, root, version)
    states = risk_states(written, distinct=False).hint("rebalance", F.col("year"))
    states.write.mode("overwrite").partitionBy("year").parquet(table_path(root, version, "risk_states"))
    # the rules that have passed say that ids are unique, so views need not look
    for name, view in build_views(written, distinct=False).items():
        renew_claim(spark, root, version)
        # one writer per year: a view is segments x periods, a year of it a few files at most
        view.hint("rebalance", F.col("year")).write.mode("overwrite").partitionBy("year").parquet(view_path(root, version, name))
    views = {name: _stored_view(spark, root, version, name) for name in VIEWS}
    _manifest(spark, {name: written[name] for name in STAR} | views).write.mode("overwrite").parquet(table_path(root, version, "manifest"))
    present = present_in_storage(spark, root, version)
    _record(spark, root, version, quality.check_views(spark, written, views, present), "append")


def _manifest(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """(name, columns, rows) of stored tables; the rows are counted from the files' footers."""
    counts = None
    for name, table in tables.items():
        columns = F.lit(", ".join(f"{column} {kind}" for column, kind in sorted(table.dtypes)))
        one = table.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("name"), columns.alias("columns"), "rows")
        counts = one if counts is None else counts.unionAll(one)
    return counts.coalesce(1)


def present_in_storage(spark: SparkSession, root: str, version: int) -> set[str]:
    """The tables and views of a version that storage holds, whatever its manifest says."""
    top, views = f"{root}/versions/{version}", f"{root}/versions/{version}/views"
    found = {name for name in STAR if folders.names(spark, f"{top}/{name}")}
    return found | {name for name in VIEWS if folders.names(spark, f"{views}/{name}")}


def verify_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """Holds what storage has of a version against its manifest: a report of rules.

    V-L11 counts tables and views that are not there, V-L12.<name> the rows that one has more or less
    than the manifest says, NULL where its columns differ or it can't be read.
    """
    present = present_in_storage(spark, root, version)
    manifest = spark.read.parquet(table_path(root, version, "manifest"))
    rows = []
    for name, columns, count in manifest.select("name", "columns", "rows").collect():  # one row per table
        difference = None
        if name in present:
            try:
                path = view_path(root, version, name) if name in VIEWS else table_path(root, version, name)
                table = _stored_view(spark, root, version, name) if name in VIEWS else spark.read.parquet(path).select(STAR[name].names)
                if ", ".join(f"{column} {kind}" for column, kind in sorted(table.dtypes)) == columns:
                    difference = abs(table.count() - count)
            except PySparkException:
                difference = None
        rows.append(("loaded", name, f"V-L12.{name}", quality.FAIL, difference, difference == 0))
    missing = len({*STAR, *VIEWS} - present)
    rows.append(("loaded", "*", quality.PRESENCE["loaded"][0], quality.FAIL, missing, missing == 0))
    return spark.createDataFrame(rows, quality.REPORT)


def missing_from_catalog(spark: SparkSession, names: list[str]) -> list[str]:
    """Expected tables or views the session's catalog does not know."""
    return [name for name in names if not spark.catalog.tableExists(name)]
