"""From a diagnosis to a dispatch order: policy, parts, service center, JSON."""

from __future__ import annotations

import json
import math
import re
from collections.abc import Callable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from signalguard.functions.scalar import json_text
from signalguard.operators.enrich import (
    AgentSpec,
    Observation,
    ToolCall,
    immediate,
    input_fields,
)


@dataclass(frozen=True)
class SeverityRule:
    severity: str
    status: str
    max_eta_miles: int | None
    shop_rule: str | None


# Dispatch policy, parts per cause, stand-in shops, texts of the order.
SEVERITY_RULES = (
    SeverityRule("CRITICAL", "URGENT", 50, "nearest"),
    SeverityRule("HIGH", "PRIORITY", 200, "nearest with specialty"),
    SeverityRule("MEDIUM", "SCHEDULED", None, "end of route"),
    SeverityRule("LOW", "MONITOR", None, None),
)
PARTS_BY_CAUSE = {
    "vibration": "wheel bearing kit",
    "engine_temp": "coolant pump",
    "oil_pressure": "oil pump seal kit",
}
FALLBACK_SHOPS = ("SHOP-AUSTIN", "SHOP-DALLAS", "SHOP-OKLAHOMA-CITY")
DISPATCH_ACTION = "dispatch_maintenance"
UNREACHABLE_RESPONSE = "MOCKED: 200 OK"


def by_severity(
    severity: Column, pick: Callable[[SeverityRule], object], rules=SEVERITY_RULES
) -> Column:
    """A property of the matching rule, NULL for an unknown severity; any letter case."""
    column = None
    for rule in rules:
        value = F.lit(pick(rule))
        hit = F.upper(severity) == rule.severity
        column = F.when(hit, value) if column is None else column.when(hit, value)
    return column


def dispatch_policy(df: DataFrame, severity: str = "severity", rules=SEVERITY_RULES) -> DataFrame:
    """Add status, max_eta_miles and shop_rule.  The rules are few and fixed: no join."""
    s = F.col(severity)
    return df.withColumns(
        {
            "status": by_severity(s, lambda r: r.status, rules),
            "max_eta_miles": by_severity(s, lambda r: r.max_eta_miles, rules).cast("int"),
            "shop_rule": by_severity(s, lambda r: r.shop_rule, rules),
        }
    )


def _plain(text: str) -> str:
    return re.sub(r"[\s_-]+", " ", text.lower())


def plain_words(text: Column) -> Column:
    """Lower case, with a single space for runs of spaces, underscores and hyphens."""
    return F.regexp_replace(F.lower(text), r"[\s_-]+", " ")


def parts_for(cause: Column, parts: Mapping[str, str] = PARTS_BY_CAUSE) -> Column:
    """Array of the parts whose keyword occurs in the cause; empty if none does."""
    low = plain_words(F.coalesce(cause, F.lit("")))
    hits = [F.when(low.contains(_plain(word)), part) for word, part in parts.items()]
    return F.array_compact(F.array(*hits))


def main_cause(cause: Column, parts: Mapping[str, str] = PARTS_BY_CAUSE) -> Column:
    """First listed keyword that occurs in the cause."""
    low = plain_words(cause)
    return F.coalesce(*[F.when(low.contains(_plain(word)), word) for word in parts])


def shop_lookup(
    df: DataFrame,
    centers: DataFrame,
    entity: str,
    shop: str = "shop_id",
    miles: str = "miles",
    specialty: str | None = None,
    cause: str = "likely_cause",
    fallback: str | None = FALLBACK_SHOPS[0],
) -> DataFrame:
    """Add shop_id and eta_miles from a table of (entity, shop, miles).

    Needs the columns of ``dispatch_policy``.  The table is reduced to one row per entity
    before the join, in one pass: its nearest shop, and the nearest for each cause that
    parts are known for.  So the right side is unique and a hot entity does not multiply.
    Rules that ask for a specialty take the nearest shop of that specialty, and the nearest
    of any where none of it lies within the limit.  A shop of unknown distance is never
    within a limit; without one it comes after all others.  Where no shop lies within the
    limit, ``fallback`` is used and eta_miles is NULL.  A rule without shop_rule gets no
    shop.
    """
    offer = F.struct(
        F.col(miles).isNull().alias("unknown"),
        F.col(miles).alias("miles"),
        F.col(shop).alias("shop"),
    )
    nearest = [F.min(offer).alias("_any")]
    chosen = F.col("_any")
    if specialty is not None:
        fitting = F.lit(None).cast(centers.select(offer.alias("o")).schema["o"].dataType)
        for i, word in reversed(list(enumerate(PARTS_BY_CAUSE))):
            special = F.min(F.when(F.col(specialty) == word, offer))
            nearest.append(special.alias(f"_near{i}"))
            fitting = F.when(main_cause(F.col(cause)) == word, F.col(f"_near{i}")).otherwise(
                fitting
            )
        special = F.col("shop_rule").contains("specialty") & _within(fitting["miles"])
        chosen = F.when(special & fitting.isNotNull(), fitting).otherwise(chosen)
    found = df.join(centers.groupBy(entity).agg(*nearest), entity, "left")
    found = found.withColumn("_shop", chosen)
    chosen = F.col("_shop")
    usable = F.col("shop_rule").isNotNull() & chosen.isNotNull() & _within(chosen["miles"])
    return found.select(
        *df.columns,
        F.when(usable, chosen["shop"])
        .when(F.col("shop_rule").isNotNull(), F.lit(fallback))
        .alias("shop_id"),
        F.when(usable, chosen["miles"]).cast("int").alias("eta_miles"),
    )


def _within(miles: Column) -> Column:
    """Only a missing limit is no limit; a missing distance is beyond any."""
    limit = F.col("max_eta_miles")
    return limit.isNull() | F.coalesce(miles <= limit, F.lit(False))


def dispatch_json(
    entity: str, parts: str = "parts_to_pre_stage", diagnosis: str = "likely_cause"
) -> Column:
    """The order with its eight fields; shop and distance stay in as null."""
    return json_text(
        F.lit(DISPATCH_ACTION).alias("action"),
        F.col(entity).cast("string").alias("truck_id"),
        F.upper("severity").alias("severity"),
        F.col("status"),
        F.col("shop_id"),
        F.col("eta_miles"),
        F.col(parts).alias("parts_to_pre_stage"),
        F.col(diagnosis).alias("diagnosis"),
    )


# --- the same policy as an agent that calls tools ---------------------------------


# Free text may hold anything, so fields are told apart by their fixed order.
_INPUT = re.compile(
    r"\A[A-Za-z_][A-Za-z0-9_]*: (?P<truck_id>.*?), severity: (?P<severity>\w*), "
    r"likely_cause: (?P<likely_cause>.*?), recommended_action: ",
    re.DOTALL,
)


def dispatch_fields(text: str) -> dict[str, str]:
    """Vehicle, severity and cause of an agent input."""
    found = _INPUT.match(text)
    return found.groupdict() if found else input_fields(text)


def offers_of(reply: Observation) -> list[dict] | None:
    """The shops of a reply, or None where it is no list of shops."""
    if not reply.ok:
        return None
    try:
        offers = json.loads(reply.text)
    except (TypeError, ValueError):
        return None
    if not isinstance(offers, list) or not all(isinstance(o, dict) for o in offers):
        return None
    return [o for o in offers if o.get("shop_id")]


def _distance(offer: dict) -> float:
    miles = offer.get("miles")
    known = isinstance(miles, (int, float)) and not isinstance(miles, bool) and miles == miles
    return float(miles) if known else math.inf


def _choose(rule: SeverityRule, known: list[str], offers: list[dict]) -> dict:
    """The rules of ``shop_lookup`` on one list of shops."""
    if rule.shop_rule is None:
        return {}
    if rule.max_eta_miles is not None:
        offers = [o for o in offers if _distance(o) <= rule.max_eta_miles]
    if "specialty" in rule.shop_rule:
        offers = [o for o in offers if o.get("specialty") in known[:1]] or offers
    place = lambda o: (_distance(o), str(o["shop_id"]))
    return min(offers, key=place, default={"shop_id": FALLBACK_SHOPS[0]})


def _order(fields: dict[str, str], shops: Observation) -> tuple[SeverityRule | None, dict]:
    severity = fields.get("severity", "").upper()
    rule = next((r for r in SEVERITY_RULES if r.severity == severity), None)
    cause = fields.get("likely_cause", "")
    plain = _plain(cause)
    known = [word for word in PARTS_BY_CAUSE if _plain(word) in plain]
    best = _choose(rule, known, offers_of(shops) or []) if rule else {}
    miles = _distance(best) if best else math.inf
    return rule, {
        "action": DISPATCH_ACTION,
        "truck_id": fields.get("truck_id"),
        "severity": severity,
        "status": rule.status if rule else None,
        "shop_id": best.get("shop_id"),
        "eta_miles": None if math.isinf(miles) else int(miles),
        "parts_to_pre_stage": [PARTS_BY_CAUSE[word] for word in known],
        "diagnosis": cause,
    }


def dispatch_step(_: str, text: str, key: str, seen: list[Observation]) -> ToolCall | str:
    """Look shops up, post the order, report: the steps of the offline dispatcher."""
    fields = dispatch_fields(text)
    if not seen:
        return ToolCall("http_get", {"truck_id": fields.get("truck_id")})
    rule, order = _order(fields, seen[0])
    if len(seen) == 1:
        return ToolCall("http_post", {"key": key, "body": order})
    posted = seen[1]
    if posted.ok:
        reply = posted.text
    elif posted.timed_out:  # the order may have arrived all the same
        reply = f"UNKNOWN: {posted.text}"
    else:
        reply = f"FAILED: {posted.text}" if posted.reachable else UNREACHABLE_RESPONSE
    target = order["shop_id"] or "the watch list"
    status = rule.status if rule else "UNKNOWN"
    return (
        f"Dispatch Summary:\n{order['truck_id']} goes to {target} as {status}.\n\n"
        f"Dispatch JSON:\n{json.dumps(order, ensure_ascii=False)}\n\n"
        f"API Response:\n{reply}"
    )


def dispatch_agent(
    http_get: Callable[[dict, str, float], str] | None = None,
    http_post: Callable[[dict, str, float], str] | None = None,
) -> AgentSpec:
    """The dispatcher with the caller's tools; without one, its endpoint is unreachable."""
    tools = {"http_get": http_get or no_endpoint, "http_post": http_post or no_endpoint}
    return AgentSpec(name="dispatcher", step=dispatch_step, tools=tools)


@immediate
def no_endpoint(arguments: dict, key: str, timeout: float) -> str:
    """A tool whose endpoint nobody listens at."""
    raise ConnectionRefusedError("no endpoint is configured")


def offer_lists(
    centers: DataFrame,
    entity: str,
    shop: str = "shop_id",
    miles: str = "miles",
    specialty: str = "specialty",
    out: str = "offers",
) -> DataFrame:
    """Per entity a JSON list of the offers the dispatcher can choose: (entity, out).

    Those are the nearest of all and the nearest of each specialty that parts are known for
    (ties: the smallest shop), so an entity has four at most, however many shops serve it.
    They are found before the shuffle, as partial minima.
    """
    offer = F.struct(
        F.col(miles).isNull().alias("unknown"),
        F.col(miles).alias("miles"),
        F.col(shop).cast("string").alias("shop_id"),
        F.col(specialty).alias("specialty"),
    )
    best = [F.min(offer)]
    best += [F.min(F.when(F.col(specialty) == word, offer)) for word in PARTS_BY_CAUSE]
    listed = F.transform(
        F.array_distinct(F.array_compact(F.array(*best))),
        lambda o: F.struct(o["shop_id"], o["miles"], o["specialty"]),
    )
    return centers.groupBy(entity).agg(F.to_json(listed).alias(out))
