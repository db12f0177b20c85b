"""Which files to fetch, what became of them, and the tallies."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from harvestlake.functions.text import storage_path
from harvestlake.operators.joins import join_to_one
from harvestlake.operators.reports import with_extension, with_url
from harvestlake.refdata import (
    DEFAULT_EXTENSIONS,
    DEFAULT_MAX_SIZE_MB,
    FAILED,
    PENDING,
    SKIPPED_EXISTS,
    SKIPPED_SIZE,
    SUCCESS,
)


@dataclass(frozen=True)
class Selection:
    """What a download run asks for."""

    status: str | None = PENDING
    extensions: tuple[str, ...] = tuple(DEFAULT_EXTENSIONS)
    resume: bool = True

    @property
    def status_filter(self) -> str | None:
        return self.status if self.resume and self.status else None


def selection(preset: str = "all", value: str | None = None) -> Selection:
    """Run options by preset: all, zip, by_type, by_status, retry_failed, everything."""
    if preset == "zip":
        return Selection(extensions=("zip",))
    if preset == "by_type":
        return Selection(extensions=(value.lower(),))
    if preset == "by_status":
        return Selection(status=value or PENDING)
    if preset == "retry_failed":
        return Selection(status=FAILED)
    if preset == "everything":
        return Selection(resume=False)
    if preset != "all":
        raise ValueError(f"unknown preset {preset!r}")
    return Selection()


def _status_matches(choice: Selection) -> Column:
    wanted = choice.status_filter
    return F.lit(True) if wanted is None else F.col("status") == wanted


def _folders(projects: DataFrame) -> DataFrame:
    return projects.select(
        F.col("id").alias("project_id"),
        "download_repository_folder",
        "download_project_folder",
        "download_version_folder",
    )


def plan_projects(
    files: DataFrame,
    projects: DataFrame,
    keys: DataFrame | None = None,
    extensions: list[str] | tuple[str, ...] = tuple(DEFAULT_EXTENSIONS),
    output_dir: str = "downloads",
    colocated: bool = False,
) -> DataFrame:
    """Files to fetch for the given projects: wanted extension and a URL, any status.

    Projects that do not exist drop out with the join that supplies the folders. The
    keys restrict the projects, not the files: the files meet one join only, with
    one row per project on the other side, so adaptive execution may split a project
    that holds very many of them. ``colocated`` says that both tables are bucketed by project
    (``sources.bucketed``); they are then joined in place, without an exchange to split.
    """
    targets = with_url(with_extension(files, list(extensions)))
    wanted = _folders(projects)
    if keys is not None:
        wanted = wanted.join(keys.select("project_id").distinct(), "project_id", "left_semi")
    joined = targets.join(wanted, "project_id") if colocated else join_to_one(targets, wanted, ["project_id"], "inner")
    return joined.select(
        *targets.columns,
        storage_path(
            output_dir,
            F.col("download_repository_folder"),
            F.col("download_project_folder"),
            F.col("download_version_folder"),
            F.col("file_name"),
        ).alias("path"),
    )


def selected_projects(files: DataFrame, choice: Selection) -> DataFrame:
    """Projects with a file of the wanted status and extension."""
    return (
        with_extension(files.where(_status_matches(choice)), list(choice.extensions))
        .select("project_id")
        .distinct()
    )


def existing_projects(groups: DataFrame, projects: DataFrame) -> DataFrame:
    """Work-list groups whose project row exists."""
    return groups.join(projects.select(F.col("id").alias("project_id")), "project_id", "left_semi")


def plan_all(
    files: DataFrame,
    projects: DataFrame,
    choice: Selection = Selection(),
    strict: bool = False,
    output_dir: str = "downloads",
    colocated: bool = False,
) -> DataFrame:
    """Files to fetch in a run over the whole catalog.

    Status and extension choose projects; within these every file of the extension
    with a URL is planned, whatever its status. ``strict=True`` keeps the status
    test on the files too, and then needs no project selection at all.
    """
    if strict:
        return plan_projects(
            files.where(_status_matches(choice)), projects, None, choice.extensions, output_dir, colocated
        )
    return plan_projects(
        files, projects, selected_projects(files, choice), choice.extensions, output_dir, colocated
    )


def exceeds_size(length: Column, max_size_mb: float = DEFAULT_MAX_SIZE_MB) -> Column:
    """True when the length is known and above the limit."""
    return F.coalesce(length, F.lit(0)) > F.lit(int(max_size_mb * 1024 * 1024))


def already_present(plan: DataFrame, inventory: DataFrame) -> DataFrame:
    """Planned files whose path is in the inventory."""
    return join_to_one(plan, inventory.select("path").distinct(), ["path"], "left_semi")


def not_present(plan: DataFrame, inventory: DataFrame) -> DataFrame:
    return join_to_one(plan, inventory.select("path").distinct(), ["path"], "left_anti")


def classify(
    plan: DataFrame,
    inventory: DataFrame,
    heads: DataFrame,
    outcomes: DataFrame,
    key: str = "id",
    max_size_mb: float = DEFAULT_MAX_SIZE_MB,
    shared_paths: bool = True,
) -> DataFrame:
    """Final status of every planned file.

    In order: already present, too large, fetched, failed; ``pending`` when there is
    no outcome yet. ``inventory(path)``, ``heads(key, content_length)`` and
    ``outcomes(key, fetched)`` may hold several rows per path or key: the largest
    length counts, and one successful fetch makes the file a success.

    Rows of one record found by several queries share a path. With ``shared_paths``
    those after the first fetched one (by project, then file) are already present.

    What is known of a path (present, first fetched row) is aggregated to one row per
    path, combining before the exchange, and joined once. A path shared by very many
    rows stays splittable.
    """
    # Both logs meet in one aggregation, so the plan is joined once.
    logged = (
        heads.select(key, "content_length")
        .unionByName(outcomes.select(key, "fetched"), allowMissingColumns=True)
        .groupBy(key)
        .agg(F.max("content_length").alias("_length"), F.bool_or("fetched").alias("_fetched"))
    )
    attempt = (
        join_to_one(plan, logged, [key])
        .withColumn(
            "_attempt",
            F.when(exceeds_size(F.col("_length"), max_size_mb), F.lit(SKIPPED_SIZE))
            .when(F.col("_fetched"), F.lit(SUCCESS))
            .when(~F.col("_fetched"), F.lit(FAILED))
            .otherwise(F.lit(PENDING)),
        )
    )
    order = F.struct("project_id", key)
    known = inventory.select("path", F.lit(True).alias("_present"))
    if shared_paths:
        fetched = attempt.where(F.col("_attempt") == SUCCESS).select("path", order.alias("_order"))
        known = known.unionByName(fetched, allowMissingColumns=True)
    else:
        known = known.withColumn("_order", F.lit(None))
    paths = known.groupBy("path").agg(
        F.bool_or("_present").alias("_present"), F.min("_order").alias("_first")
    )
    exists = F.col("_present")
    if shared_paths:
        exists = F.coalesce(exists, F.lit(False)) | (order > F.col("_first"))
    return join_to_one(attempt, paths, ["path"]).select(
        *plan.columns,
        F.when(exists, F.lit(SKIPPED_EXISTS)).otherwise(F.col("_attempt")).alias("new_status"),
    )


def _count_if(condition: Column) -> Column:
    return F.count_if(F.coalesce(condition, F.lit(False)))


def outcome_tally(files: DataFrame, status: str = "status") -> DataFrame:
    """Success, failed and everything else as one row."""
    state = F.col(status)
    return files.agg(
        F.count_if(state == SUCCESS).alias("success"),
        F.count_if(state == FAILED).alias("failed"),
        F.count_if(~state.isin(SUCCESS, FAILED)).alias("skipped"),
    )


def project_tallies(
    files: DataFrame,
    projects: DataFrame,
    extensions: list[str] | tuple[str, ...] = tuple(DEFAULT_EXTENSIONS),
    status: str = "new_status",
    choice: Selection = Selection(),
) -> DataFrame:
    """Per project: the tally of its planned files, and what the run saw of it.

    ``files`` carries every file with its final status in ``status``. A project
    without a planned file skips all its files, otherwise files that were not
    planned count nowhere; a project that does not exist skips one. One aggregation
    over the files; nothing is joined back to them.
    """
    wanted = F.col("file_type").isin(list(extensions))
    planned = wanted & F.col("download_url").isNotNull() & (F.col("download_url") != "")
    state = F.col(status)
    facts = files.groupBy("project_id").agg(
        F.count("*").alias("n_files"),
        _count_if(_status_matches(choice)).alias("n_status"),
        _count_if(_status_matches(choice) & wanted).alias("n_matching"),
        _count_if(planned).alias("n_planned"),
        _count_if(planned & (state == SUCCESS)).alias("_success"),
        _count_if(planned & (state == FAILED)).alias("_failed"),
    )
    known = projects.select(F.col("id").alias("project_id"), F.lit(True).alias("known"))
    zero = F.lit(0).cast("bigint")
    found = F.col("known").isNotNull()
    return facts.join(known, "project_id", "left").select(
        "project_id",
        "n_status",
        "n_matching",
        F.coalesce("known", F.lit(False)).alias("known"),
        F.when(found, F.col("_success")).otherwise(zero).alias("success"),
        F.when(found, F.col("_failed")).otherwise(zero).alias("failed"),
        F.when(~found, F.lit(1).cast("bigint"))
        .when(F.col("n_planned") == 0, F.col("n_files"))
        .otherwise(F.col("n_planned") - F.col("_success") - F.col("_failed"))
        .alias("skipped"),
    )


def run_tally(
    files: DataFrame,
    projects: DataFrame,
    choice: Selection = Selection(),
    status: str = "new_status",
) -> DataFrame:
    """Tally of a whole run as one row.

    Only existing projects with a file of the wanted status and extension take
    part. If no file at all has a wanted extension, every file of the wanted status
    counts as skipped.
    """
    per_project = project_tallies(files, projects, choice.extensions, status, choice)
    takes_part = F.col("known") & (F.col("n_matching") > 0)

    def total(name: str) -> Column:
        return F.coalesce(F.sum(F.when(takes_part, F.col(name))), F.lit(0)).alias(name)

    sums = per_project.agg(
        total("success"),
        total("failed"),
        total("skipped"),
        F.coalesce(F.sum("n_status"), F.lit(0)).alias("n_status"),
        F.coalesce(F.sum("n_matching"), F.lit(0)).alias("n_matching"),
    )
    return sums.select(
        "success",
        "failed",
        F.when(F.col("n_matching") == 0, F.col("n_status"))
        .otherwise(F.col("skipped"))
        .alias("skipped"),
    )
