"""The fact jobs by validator name; callers may add or replace some."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame

from signpost import values as V
from signpost.operators.facts import catalog, commerce, contracts, texts

FactJob = Callable[[DataFrame], DataFrame]


@dataclass(frozen=True)
class Validator:
    """A fact job with the probes it judges: probe key -> (path, body limit, control group)."""

    job: FactJob
    probes: dict[str, tuple[str, int, str | None]] = field(default_factory=dict)
    statuses: tuple[int, ...] = (200,)
    empty_body: bool = False  # whether an empty body is worth a look


_JOBS: dict[str, FactJob] = {
    "homepage": texts.homepage_facts,
    "robots": texts.robots_facts,
    "sitemap": texts.sitemap_facts,
    "llms": texts.llms_facts,
    "commerce": commerce.commerce_facts,
    "ucp": commerce.ucp_facts,
    "agent": contracts.agent_facts,
    "agents": contracts.agents_facts,
    "openapi": contracts.openapi_facts,
    "x402": contracts.x402_facts,
    "payment_probe": contracts.payment_probe_facts,
    "products": catalog.product_facts,
    "cart": catalog.cart_facts,
    "ucp_catalog": catalog.catalog_answer_facts,
}
VALIDATORS: dict[str, Validator] = {
    name: Validator(
        job, {key: (path, limit, group) for key, path, validator, limit, group in V.PROBES + V.FOLLOW_UP_CAPTURES if validator == name},
        tuple(V.ALLOWED_STATUSES.get(name, [200])), name in V.EMPTY_BODY_VALIDATORS)
    for name, job in _JOBS.items()
}


def register_fact_job(
    name: str, job: FactJob, probes: dict[str, tuple[str, int, str | None]] | None = None, statuses: tuple[int, ...] | None = None, empty_body: bool | None = None,
) -> None:
    """`job` maps captured responses to rows with `is_valid`, `detail` and a `facts` struct.

    A known name keeps its probes and rules unless others are given; a new one must bring its probes.
    """
    known = VALIDATORS.get(name)
    if known is None and not probes:
        raise ValueError(f"the new validator {name!r} needs the probes it judges")
    base = known or Validator(job)
    VALIDATORS[name] = Validator(
        job, probes or base.probes, statuses or base.statuses, base.empty_body if empty_body is None else empty_body)
