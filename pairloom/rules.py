"""Routing rules: the fixed word lists, and the default rule tables built on them.

A rule is a condition and the labels a row gets when it holds. A track is a list of rules of
which the first that holds counts. `operators.routing.route` takes a list of tracks and emits
a row once per track that has a hit, so alternatives share a track and overlaps get their own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from typing import Any

from pyspark.sql import Column, functions as F

# ---- Fixed values: must equal those of the data's producers ----------------------------

PLACEHOLDERS = ("", "-", "_", ".", "null", "none", "all", "undefined", "●", "?", "¿", "0",
                "1", "na", "n/a", "nan")

EXACT, SIMILAR, REJECT = "exact_match", "similar_match", "not_a_match"

PETS, GROCERY, OFFICE = "pets", "grocery", "office_supplies"
DOMAINS = (PETS, OFFICE, GROCERY)

#: Companies of each segment.
COMPANIES = {
    PETS: ("chewy", "petco"),
    GROCERY: ("wholefoods", "farmstead", "imperfect"),
    OFFICE: ("staples",),
}
REVIEWED_COMPANY = "btfastlane"
DROPPED_COMPANY = "agg_ml"
VERIFIED_STATES = ("both_customer_manager_verified", "customer_verified")
LIVE_STATUS = "product_found"

#: Model names behind each source of a pets match (case counts).
PETS_MODELS = {
    "legacy": ("ManualInternal", "ManualExternal", "MLT"),
    "legacy_ml": ("SimEngineAutov1", "SimEnginev1"),
    "fastlane": ("ml_v1.0", "ml", "btfastlane-ml", "btfastlane-ml_v1.0", "btfastlaneMock-ml"),
    "upc_legacy": ("UPCMatch", "upc", "btfastlane-upc"),
}
PETS_MANUAL_WORD = "Manual-"

#: Words in an office model name behind each source (case counts).
OFFICE_WORDS = {"fastlane": "fastlane", "manual": "Manual"}

#: Words in a lower-cased model name behind each source of a rejected pair.
REJECT_WORDS = {
    "manual": ("manual",),
    "fastlane_customer_scrape_rejected": ("fastlane", "ml"),
    "upc": ("upc",),
    "transitive": ("transitive",),
}

EXACT_ANSWERS = ("exact_match", "exact_match_dq_issue", "exact_match_with_image")
REJECT_ANSWERS = ("not_a_match", "not_match_image", "not_match_dq_issue")
UNDECIDED_ANSWERS = ("unsure",)
REVIEW_SOURCE = "fastlane"
DROPPED_WORKFLOWS = ("internal-auditor", "fastlane")
QUEUE_WORDS = {GROCERY: "grocery", OFFICE: "staples"}

#: Source name of each pair feed.
FEED_SOURCES = {"transitive": "transitive", "exact_desc": "exact_desc_match", "upc": "upc"}
#: Feeds of which only the rows of DOMAINS are read.
DOMAIN_FEEDS = ("transitive", "upc")

ALIASES = {"chewyinternal": "chewy"}

#: Families of matches; on equal join keys the earlier one survives.
MATCH_FAMILIES = (GROCERY, PETS, OFFICE, "reviews", "transitive", "exact_desc", "upc")
REJECT_FAMILIES = ("library", "reviews")

#: The id a job of this domain prefers in join keys; other domains take the UPC.
PREFERRED_IDS = {PETS: "sku"}

# ---- Rules -----------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    when: Column
    labels: Mapping[str, Any]

    def only(self, condition: Column) -> "Rule":
        return Rule(self.when & condition, self.labels)

    def with_labels(self, **labels: Any) -> "Rule":
        return Rule(self.when, {**self.labels, **labels})


Track = list[Rule]


def contains_any(column: Column, words: Sequence[str]) -> Column:
    return reduce(Column.__or__, [column.contains(w) for w in words])


def company_in(segment: str) -> Column:
    return F.col("company_code").isin(*COMPANIES[segment])


def segment_tracks() -> list[Track]:
    """Segment of a rejected library row, by company."""
    return [[Rule(company_in(s), {"segment": s}) for s in COMPANIES]]


def reject_source_tracks(model: Column | None = None) -> list[Track]:
    """Sources of a rejected library row; a model name may carry several of the words."""
    model = F.lower("model_used") if model is None else model
    return [[Rule(contains_any(model, words), {"match_source": source})]
            for source, words in REJECT_WORDS.items()]


def pets_tracks() -> list[Track]:
    """Pets matches. The model lists do not overlap, so all rules share one track."""
    model, kind = F.col("model_used"), F.col("match")
    labels = {"type": EXACT, "segment": PETS}
    by_source = {s: model.isin(*names) for s, names in PETS_MODELS.items()}
    by_source["manual"] = model.contains(PETS_MANUAL_WORD)
    exact = [Rule(company_in(PETS) & hit & (kind == "exact"), {**labels, "match_source": s})
             for s, hit in by_source.items()]
    similar = [Rule(company_in(PETS) & by_source[s] & (kind == "similar"),
                    {**labels, "match_source": s, "type": SIMILAR})
               for s in ("legacy", "manual")]
    reviewed = Rule((F.col("company_code") == REVIEWED_COMPANY)
                    & F.col("customer_review_state").isin(*VERIFIED_STATES)
                    & (kind == "exact"),
                    {**labels, "match_source": "fastlane"})
    return [exact + similar + [reviewed]]


def grocery_tracks() -> list[Track]:
    return [[Rule(company_in(GROCERY) & (F.col("match") == "exact"),
                  {"type": EXACT, "match_source": "legacy", "segment": GROCERY})]]


def office_tracks() -> list[Track]:
    """Office matches; a model name may carry both words."""
    kinds = {"exact": EXACT, "equivalent": SIMILAR}
    return [[Rule(company_in(OFFICE) & F.col("model_used").contains(word)
                  & (F.col("match") == kind),
                  {"type": label, "match_source": source, "segment": OFFICE})
             for kind, label in kinds.items()]
            for source, word in OFFICE_WORDS.items()]


def answer_tracks() -> list[Track]:
    """Type of a review answer: anything but the listed answers means similar."""
    answer = F.col("answer")
    return [[Rule(answer.isin(*EXACT_ANSWERS), {"type": EXACT}),
             Rule(answer.isin(*REJECT_ANSWERS), {"type": REJECT}),
             Rule(~answer.isin(*UNDECIDED_ANSWERS), {"type": SIMILAR})]]


def queue_tracks() -> list[Track]:
    """Segments of a review queue; a queue name may carry both words, one without is pets."""
    queue = F.col("queue_name")
    first, second = QUEUE_WORDS.items()
    return [[Rule(queue.contains(first[1]), {"segment": first[0]}),
             Rule(~queue.contains(second[1]), {"segment": PETS})],
            [Rule(queue.contains(second[1]), {"segment": second[0]})]]
