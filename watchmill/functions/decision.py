"""From scores to actions, plans and workflows."""

from functools import reduce

from pyspark.sql import Column, functions as F

from watchmill import fixed_values as V


def ensemble(members: dict[str, Column], weights: dict[str, float] = V.MEMBER_WEIGHTS) -> Column:
    return reduce(lambda a, b: a + b, [F.lit(w) * members[name] for name, w in weights.items()])


def is_threat(score: Column, threshold: float = V.DEFAULT_THRESHOLD) -> Column:
    return score >= F.lit(threshold)


def determine_action(score: Column) -> Column:
    return (
        F.when(score < V.ALLOW_BELOW, "ALLOW")
        .when(score < V.MONITOR_BELOW, "MONITOR")
        .when(score < V.BLOCK_BELOW, "BLOCK")
        .otherwise("CRITICAL_ALERT")
    )


def is_high_severity(threat: Column, action: Column) -> Column:
    return threat & action.isin("BLOCK", "CRITICAL_ALERT")


def is_auto_allowed(threat: Column, action: Column) -> Column:
    """Neither waiting for a decision nor under observation."""
    return ~is_high_severity(threat, action) & ~(threat & (action == "MONITOR"))


def affected_service(anomaly: Column, action: Column) -> Column:
    return (
        F.when(anomaly.isin(V.EXFILTRATION), "elasticsearch")
        .when(anomaly.isin(V.MOVEMENT), "kafka")
        .when(action == "admin", "database")
        .otherwise("elasticsearch")
    )


def rotation_plan(threat: Column, threat_action: Column, anomaly: Column, action: Column) -> Column:
    high = is_high_severity(threat, threat_action)
    critical = high & (threat_action == "CRITICAL_ALERT")
    return F.struct(
        F.when(high, "pending_admin_approval")
        .when(threat & (threat_action == "MONITOR"), "monitoring")
        .otherwise("no_rotation_needed")
        .alias("status"),
        high.alias("user_rotation"),
        critical.alias("infra_rotation"),
        F.when(critical, affected_service(anomaly, action)).alias("affected_service"),
        F.when(critical, V.CRITICAL_PLAN_REASON)
        .when(high, V.BLOCK_PLAN_REASON)
        .when(threat & (threat_action == "MONITOR"), V.MONITOR_MESSAGE)
        .alias("reason"),
    )


def rotation_status(threat: Column, threat_action: Column) -> Column:
    high = is_high_severity(threat, threat_action)
    return (
        F.when(high & (threat_action == "CRITICAL_ALERT"), "pending_user_and_infra_rotation")
        .when(high, "pending_user_rotation")
        .otherwise("skipped")
    )


def _workflow(entry: tuple[str, str, str]) -> Column:
    name, status, priority = entry
    return F.struct(F.lit(name).alias("name"), F.lit(status).alias("status"), F.lit(priority).alias("priority"))


def workflows(threat: Column, score: Column) -> Column:
    base = [_workflow(w) for w in V.THREAT_WORKFLOWS]
    return (
        F.when(threat & (score > V.ISOLATE_ABOVE), F.array(*base, _workflow(V.ISOLATION_WORKFLOW)))
        .when(threat, F.array(*base))
        .otherwise(F.array(_workflow(V.CALM_WORKFLOW)))
    )


def incident_id(threat: Column, event_id: Column) -> Column:
    """Only threats open an incident; the id follows from the event, so a retry gives the same one."""
    return F.when(threat, F.concat(F.lit("INC-"), F.upper(F.left(F.sha2(event_id.cast("string"), 256), F.lit(32)))))


def distribution(threat: Column) -> Column:
    targets = F.array(*[
        F.struct(
            F.lit(t).alias("target"),
            F.lit(V.DISTRIBUTION_METHOD).alias("method"),
            F.lit(V.DISTRIBUTION_ENCRYPTION).alias("encryption"),
        )
        for t in V.DISTRIBUTION_TARGETS
    ])
    return F.when(threat, targets).otherwise(F.slice(targets, 1, 0))


def alert_id(event_id: Column) -> Column:
    """128 bits of the event id's digest: shorter ids would collide in a table of billions."""
    return F.concat(F.lit("ALR-"), F.upper(F.left(F.sha2(event_id.cast("string"), 256), F.lit(32))))


def infra_mechanism(service: Column) -> Column:
    return F.when(service == "kafka", "vault_kv_rotation").otherwise("vault_database_engine")


def infra_role(service: Column) -> Column:
    """Which database role a service's lease is issued for; a key-value service has none."""
    roles = reduce(lambda c, kv: c.when(service == kv[0], kv[1]), V.INFRA_ROLES.items(), F)
    return F.when(service != "kafka", roles.otherwise(V.OTHER_INFRA_ROLE))


def lease_seconds(role: Column) -> Column:
    return reduce(lambda c, kv: c.when(role == kv[0], kv[1]), V.LEASE_SECONDS.items(), F)
