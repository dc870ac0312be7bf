"""User credentials and infrastructure leases as tables that follow from the rotations. No secret is made here."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from watchmill import fixed_values as V
from watchmill.functions import decision as D
from watchmill.functions.display import mask_edges, mask_prefix

_SLICE_US = 3_600_000_000


def provisioning(profiles: DataFrame, ledger: DataFrame) -> DataFrame:
    """What bringing the ledger in line with the profiles takes, per user."""
    have = ledger.select("user_id", F.col("role").alias("old_role"), F.col("home_region").alias("old_region"))
    same = F.col("role").eqNullSafe(F.col("old_role")) & F.col("home_region").eqNullSafe(F.col("old_region"))
    step = F.when(F.col("found").isNull(), "create").when(same, "skip").otherwise("update")
    return profiles.join(have.withColumn("found", F.lit(True)), "user_id", "left").select(
        "user_id", "role", "home_region", step.alias("step")
    )


def rotation_counts(rotations: DataFrame) -> DataFrame:
    return rotations.groupBy("rotation_type", "target").agg(F.count("*").alias("rotation_count"))


def rotation_numbers(rotations: DataFrame) -> DataFrame:
    """The running number of each rotation of its target.

    A target may be rotated very often: rows are numbered inside target and hour, and the sizes of the
    earlier hours are added.
    """
    rows = rotations.withColumn("hour", F.floor(F.col("at_us") / F.lit(_SLICE_US)))
    key = ["rotation_type", "target"]
    sizes = rows.groupBy(*key, "hour").agg(F.count("*").alias("n"))
    before = Window.partitionBy(*key).orderBy("hour").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*key, "hour", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    inside = F.row_number().over(Window.partitionBy(*key, "hour").orderBy("at_us", "rotation_id"))
    return (
        rows.withColumn("inside", inside)
        .join(sizes, [*key, "hour"])
        .withColumn("rotation_number", F.col("earlier") + F.col("inside"))
        .drop("hour", "inside", "earlier")
    )


def user_ledger(profiles: DataFrame, rotations: DataFrame) -> DataFrame:
    """Every user with the number of rotations and the last one."""
    last = F.max_by(F.struct("reason", "trigger_score", "at_us"), F.struct("at_us", "rotation_id"))
    per_user = rotations.filter(F.col("rotation_type") == "user").groupBy("target").agg(
        F.count("*").alias("n"), last.alias("last")
    )
    rows = profiles.join(per_user, F.col("user_id") == F.col("target"), "left")
    rotated = F.col("n").isNotNull()
    return rows.select(
        "user_id",
        "role",
        "home_region",
        F.coalesce("n", F.lit(0)).alias("rotation_count"),
        F.when(rotated, "rotated").otherwise("active").alias("status"),
        F.coalesce("last.reason", F.lit("initial_provisioning")).alias("last_rotation_reason"),
        F.col("last.trigger_score").alias("triggered_by_threat_score"),
        F.col("last.at_us").alias("created_us"),
    )


def with_profile_fields(ledger: DataFrame, profiles: DataFrame) -> DataFrame:
    """Ledger rows with role and region filled in from the profile where they are missing."""
    fill = profiles.select("user_id", F.col("role").alias("p_role"), F.col("home_region").alias("p_region"))
    return fill.join(ledger, "user_id", "left").select(
        "user_id",
        F.coalesce("role", "p_role").alias("role"),
        F.coalesce("home_region", "p_region").alias("home_region"),
        F.coalesce("rotation_count", F.lit(0)).alias("rotation_count"),
        F.coalesce("status", F.lit("unknown")).alias("status"),
    )


def masked(credentials: DataFrame) -> DataFrame:
    return credentials.withColumns({
        "db_password": mask_edges(F.col("db_password")),
        "api_key": mask_prefix(F.col("api_key")),
        "service_token": mask_prefix(F.col("service_token")),
    })


def latest_rotated(ledger: DataFrame) -> DataFrame:
    """The user rotated last; the smallest id on ties."""
    return ledger.filter(F.col("status") == "rotated").orderBy(F.desc("created_us"), "user_id").limit(1)


def service_routes(services: DataFrame) -> DataFrame:
    role = D.infra_role(F.col("service"))
    return services.select(
        "service", D.infra_mechanism(F.col("service")).alias("mechanism"), role.alias("role"),
        D.lease_seconds(role).alias("lease_seconds"),
    )


def issue_leases(rotations: DataFrame) -> DataFrame:
    """A lease per infrastructure rotation of a service whose credentials have one."""
    role = D.infra_role(F.col("target"))
    seconds = D.lease_seconds(role)
    rows = rotations.filter((F.col("rotation_type") == "infrastructure") & (F.col("target") != "kafka"))
    return rows.select(
        F.col("target").alias("service"),
        F.concat(F.lit("database/creds/"), role, F.lit("/"), F.left("rotation_id", F.lit(24))).alias("lease_id"),
        F.concat(F.lit("v-"), F.left("rotation_id", F.lit(12))).alias("username"),
        F.col("at_us").alias("issued_us"),
        (F.col("at_us") + seconds.cast("bigint") * 1_000_000).alias("expires_us"),
        F.col("reason").alias("rotation_reason"),
    )


def active_leases(leases: DataFrame, as_of_us: Column) -> DataFrame:
    """The newest lease of each service at a moment, and how long it still runs."""
    names = [c for c in leases.columns if c != "service"]
    newest = leases.filter(F.col("issued_us") <= as_of_us).groupBy("service").agg(
        F.max_by(F.struct(*names), F.struct("issued_us", "lease_id")).alias("l")
    )
    left = ((F.col("l.expires_us") - as_of_us) / F.lit(1_000_000)).cast("bigint")
    return newest.select(
        "service", "l.*", F.greatest(left, F.lit(0)).alias("seconds_remaining"), (left <= 0).alias("expired")
    )


def revocations(leases: DataFrame) -> DataFrame:
    """A new lease revokes the one before it.

    There are only a few services, so each holds many leases: rows are linked inside service and hour, and
    one row per hour links the hours.
    """
    rows = leases.withColumn("hour", F.floor(F.col("issued_us") / F.lit(_SLICE_US)))
    order = F.struct("issued_us", "lease_id")
    edges = rows.groupBy("service", "hour").agg(
        F.max(order).alias("last_here"), F.min(order).alias("first_here")
    )
    by_hour = Window.partitionBy("service").orderBy("hour")
    edges = edges.select(
        "service", "hour", F.lag("last_here").over(by_hour).alias("last_before"),
        F.lead("first_here").over(by_hour).alias("first_after"),
    )
    inside = Window.partitionBy("service", "hour").orderBy("issued_us", "lease_id")
    rows = rows.withColumns({"near_before": F.lag(order).over(inside), "near_after": F.lead(order).over(inside)})
    rows = rows.join(edges, ["service", "hour"])
    before, after = F.coalesce("near_before", "last_before"), F.coalesce("near_after", "first_after")
    return rows.withColumns({
        "previous_lease": before["lease_id"], "revoked": after.isNotNull(), "revoked_us": after["issued_us"],
    }).select(*leases.columns, "previous_lease", "revoked", "revoked_us")
