"""Severity bands and anomaly-type rules as data, turned into ``when`` chains."""

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.functions.features import as_column


@dataclass(frozen=True)
class Rule:
    """One row of a rule table.

    ``predicate`` is a SQL condition with ``{column}`` placeholders. A placeholder becomes the
    column, or the default below where the table has no such column. A null that a left-to-right
    reading meets before the condition is decided means no match, hence the IS NOT NULL guards.
    """

    label: str
    action: str
    predicate: str
    defaults: dict = field(default_factory=dict)


# Bands, labels, actions and rule limits of the alert schema.
SEVERITY_BANDS = [("CRITICAL", 0.92), ("HIGH", 0.80), ("MEDIUM", 0.65), ("LOW", 0.50)]

ENGINE_RULES = [
    Rule(
        "DDoS / Traffic Spike",
        "Apply rate-limiting on affected interfaces; check for DDoS attack; "
        "consider null-routing attacker source.",
        "{packet_rate} IS NOT NULL AND ({packet_rate} > 300 OR ({connection_count_5min} IS NOT NULL"
        " AND ({connection_count_5min} > 150 OR ({packets_count} > 500 AND {duration} < 5))))",
        {"packet_rate": 0, "connection_count_5min": 0, "packets_count": 0, "duration": 99},
    ),
    Rule(
        "Port Scan",
        "Block source IP at perimeter firewall; review ACLs; "
        "alert security team for further investigation.",
        "{duration} < 0.05D AND {packets_count} <= 3 AND {is_well_known_port} = 0",
        {"duration": 1, "packets_count": 10, "is_well_known_port": 0},
    ),
    Rule(
        "Data Exfiltration",
        "Isolate source host immediately; capture full packet trace; "
        "initiate DLP incident response procedure.",
        "{bytes_transferred} IS NOT NULL AND ({bytes_transferred} > 500000 OR ({bytes_rate} IS NOT"
        " NULL AND ({bytes_rate} > 50000 OR ({duration} > 30 AND {bytes_per_packet} > 5000))))",
        {"bytes_transferred": 0, "bytes_rate": 0, "duration": 0, "bytes_per_packet": 0},
    ),
    Rule(
        "Packet Loss / Network Degradation",
        "Check interface error counters; verify physical layer; "
        "inspect QoS policy; consider failover to backup path.",
        "{packet_rate} > 0 AND {packet_rate} < 2 AND {bytes_transferred} > 1000",
        {"packet_rate": 1, "bytes_transferred": 0},
    ),
]
ENGINE_OTHER = (
    "Unknown Anomaly",
    "Investigate traffic source manually; correlate with other events; "
    "escalate to NOC if pattern persists.",
)

REPLAY_RULES = [
    Rule(
        "DDoS / Traffic Spike",
        "Check for DDoS attacks; apply rate-limiting on affected interfaces.",
        "{packet_rate} IS NOT NULL AND ({packet_rate} > 300 OR {packets_count} > 500)",
        {"packet_rate": 0, "packets_count": 0},
    ),
    Rule(
        "Port Scan",
        "Block source IP; review firewall rules.",
        "{duration} < 0.05D AND {packets_count} <= 3",
        {"duration": 1, "packets_count": 0},
    ),
    Rule(
        "Data Exfiltration",
        "Isolate host; capture traffic for forensic analysis.",
        "{bytes_transferred} IS NOT NULL AND ({bytes_transferred} > 500000 OR {bytes_rate} > 50000)",
        {"bytes_transferred": 0, "bytes_rate": 0},
    ),
]
REPLAY_OTHER = ("Unknown Anomaly", "Investigate traffic source; escalate to NOC.")

SPIKE_MESSAGE = (
    "DDoS suspected: current rate %.0f pkt/s is %.1fx baseline %.0f pkt/s; "
    "%d unique sources in last 20 records."
)
LOSS_MESSAGES = {
    "CRITICAL": "Severe packet-loss trend: rate dropped %.0f%% (from %.1f to %.1f pkt/s). "
                "Check physical layer; consider interface failover.",
    "WARN": "Packet-loss trend detected: rate dropped %.0f%% (from %.1f to %.1f pkt/s). "
            "Monitor interface error counters; schedule maintenance window.",
}
# End of fixed values.

RULESETS = {"engine": (ENGINE_RULES, ENGINE_OTHER), "replay": (REPLAY_RULES, REPLAY_OTHER)}


def severity(score) -> Column:
    """Band of a score; everything below the last band is LOW too."""
    score = as_column(score)
    chain = F
    for name, floor in SEVERITY_BANDS:
        chain = chain.when(score >= floor, name)
    return chain.otherwise(SEVERITY_BANDS[-1][0])


def anomaly_type(df: DataFrame, ruleset="engine") -> DataFrame:
    """Add ``anomaly_type`` and ``recommended_action``: the first matching rule wins.

    ``ruleset`` is a name, or a pair (rules, (label, action) when none matches).
    """
    rules, (other_label, other_action) = (
        RULESETS[ruleset] if isinstance(ruleset, str) else ruleset
    )
    have = set(df.columns)
    label = action = F
    for rule in rules:
        bound = {c: c if c in have else str(d) for c, d in rule.defaults.items()}
        hit = F.expr(rule.predicate.format(**bound))
        label = label.when(hit, rule.label)
        action = action.when(hit, rule.action)
    return df.withColumns({
        "anomaly_type": label.otherwise(other_label),
        "recommended_action": action.otherwise(other_action),
    })
