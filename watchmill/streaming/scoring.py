"""A stream of events, scored by trained members and turned into predictions."""

from pyspark.sql import DataFrame, functions as F

from watchmill import schema as S
from watchmill.operators.features import attach_profile, finish_features, zero_on_error
from watchmill.operators.projection import named_users, to_network_event
from watchmill.plans.scoring import decide, respond
from watchmill.plans.training import Bundle, member_scores
from watchmill.streaming.state import exact_history, serving_history


def event_rows(messages: DataFrame) -> DataFrame:
    """Messages -> events with defaults. Blank users go to a side table (``blank_users``), not into the state.

    Profile fields are left out: they come from the profiles.
    """
    events = named_users(to_network_event(messages))
    return events.select(*[c for c in S.NETWORK_LOG.names])


def predict_stream(
    events: DataFrame, profiles: DataFrame, bundle: Bundle, mode: str = "exact", delay: str = "10 minutes"
) -> DataFrame:
    """The batch job's features and decisions on a stream; one exchange, on the user, into the keyed state."""
    rows = serving_history(events) if mode == "serving" else exact_history(events, delay)
    rows = zero_on_error(finish_features(attach_profile(rows, profiles), bundle.codes, mode))
    numbers = {c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in S.FEATURE_COLUMNS}
    scored = member_scores(rows.withColumns(numbers), bundle.members)
    return respond(decide(scored, bundle.threshold, bundle.weights))
