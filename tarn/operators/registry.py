"""Accounts, tenants, datasets and jobs: joins, eligibility and validation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def looked_up(requests: DataFrame, registry: DataFrame, on: list[str]) -> DataFrame:
    """Requests with their registry row and whether there is one. Spark broadcasts the registry if it is small."""
    return requests.join(registry.withColumn("_found", F.lit(True)), on, "left").withColumn("found", F.coalesce("_found", F.lit(False))).drop("_found")


def assembled(accounts: DataFrame, tenants: DataFrame, datasets: DataFrame) -> DataFrame:
    """One row a tenant with its datasets as a sorted array; tenants without datasets are kept."""
    rows = accounts.join(tenants, "account").join(datasets, ["tenant"], "left")
    listed = F.sort_array(F.collect_list(F.when(F.col("dataset").isNotNull(), F.col("dataset"))))
    return rows.groupBy("account", "tenant").agg(listed.alias("datasets"), F.count("dataset").alias("n_datasets"))


def eligible(rows: DataFrame, deployment: str | None = None) -> DataFrame:
    """Rows whose account, tenant and dataset are active, of the deployment type if one is set."""
    active = F.col("account_active") & F.col("tenant_active") & F.col("dataset_active")
    return rows.where(active if deployment is None else active & F.col("deployment").eqNullSafe(F.lit(deployment)))


def deliverable(rows: DataFrame) -> DataFrame:
    """Rows whose destination is there, active and of a supported kind."""
    return rows.where(F.col("destination").isNotNull() & F.lower("destination_type").isin("s3", "minio") & F.coalesce("destination_active", F.lit(False)))


def lanes(rows: DataFrame, testing: str = "testing") -> tuple[DataFrame, DataFrame]:
    """The fast lane (testing) and the normal one; rows without the flag are normal."""
    fast = F.coalesce(F.col(testing), F.lit(False))
    return rows.where(fast), rows.where(~fast)


def violations(tenant: Column, dataset: Column, kind: Column) -> Column:
    """The rules that a job record breaks, as an array."""
    rules = {
        "literal string": (tenant == "string") | (dataset == "string"),
        "tenant empty": F.coalesce(tenant, F.lit("")) == "",
        "dataset empty": F.coalesce(dataset, F.lit("")) == "",
        "type empty": F.coalesce(kind, F.lit("")) == "",
    }
    return F.array_compact(F.array(*[F.when(F.coalesce(broken, F.lit(False)), F.lit(name)) for name, broken in rules.items()]))


def referenced(jobs: DataFrame, registry: DataFrame) -> DataFrame:
    """Jobs with a reason if their tenant, or their dataset within it, isn't in the registry (tenant, dataset)."""
    tenants = registry.select("tenant", F.lit(True).alias("_t")).distinct()
    pairs = registry.select("tenant", "dataset", F.lit(True).alias("_d")).distinct()
    rows = jobs.join(tenants, "tenant", "left").join(pairs, ["tenant", "dataset"], "left")
    return rows.withColumn("reason", F.when(F.col("_t").isNull(), "tenant not found").when(F.col("_d").isNull(), "dataset not found")).drop("_t", "_d")


def not_in_flight(requests: DataFrame, jobs: DataFrame, on: list[str]) -> DataFrame:
    """Requests for which no job is queued, retrying or running."""
    return requests.join(jobs.where(F.col("state").isin("queue", "retry", "running")).select(*on).distinct(), on, "left_anti")


def completed_requests(requests: DataFrame) -> DataFrame:
    """Requests with both ids; priority 0 or none becomes 1."""
    return requests.where(F.col("tenant").isNotNull() & F.col("dataset").isNotNull()).withColumn("priority", F.coalesce(F.nullif("priority", F.lit(0)), F.lit(1)))


def due(jobs: DataFrame, now: Column) -> DataFrame:
    return jobs.where((F.col("state") == "retry") & (F.col("retry_after") < now))


def overaged(rows: DataFrame, limits: dict[str, int], now: Column, kind: str = "kind", time: str = "created") -> DataFrame:
    """Rows older than their kind's limit in hours; kinds without a limit never age."""
    hours = F.create_map(*[F.lit(x) for pair in limits.items() for x in pair])
    age = F.unix_seconds(now.cast("timestamp")) - F.unix_seconds(F.col(time).cast("timestamp"))
    return rows.where(age > F.try_element_at(hours, F.col(kind)) * 3600)


def admitted(waiting: DataFrame, queued: DataFrame, by: list[str], order: list[str], most: int) -> DataFrame:
    """The first of the waiting jobs for which a queue of at most ``most`` has room beside what is queued."""
    from pyspark.sql import Window

    place = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    first = waiting.withColumn("_place", place).where(F.col("_place") <= most)
    rows = first.join(queued.groupBy(*by).agg(F.count("*").alias("_queued")), by, "left")
    return rows.where(F.col("_place") <= most - F.coalesce("_queued", F.lit(0))).drop("_place", "_queued")
