"""The jobs in their fixed order.

A run may be given a name. Then each step is noted in the store when it is done, and a run of the same name that was broken off
goes on with the step it had reached: the steps are keyed updates, so the one that failed half way may run again.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from panelwright.plans import index, prices
from panelwright.plans.vendor import ASSET_FEEDS, COVARIANCE_FEED, EXPOSURE_FEED, FACTOR_RETURN_FEED, VendorJobs
from panelwright.specs import PRICE_HISTORY_START, RISK_MODEL_START
from panelwright.store import PanelStore

Step = tuple[str, Callable[[], None]]


def run_steps(store: PanelStore, run: str | None, steps: list[Step]) -> None:
    """Do the steps in order; with a run's name only those that it has not finished yet."""
    for name, work in steps:
        if run is None or not store.is_noted(run, name):
            work()
            if run is not None:
                store.note(run, name)


def risk_model_daily(jobs: VendorJobs, run: str | None = None) -> None:
    """Asset rows, exposures, covariances, factor returns, then identifiers and metadata.

    The four asset feeds make one rewrite of the touched years, the three interval maps another.
    """
    run_steps(jobs.store, run, [
        ("assets", lambda: jobs.daily(*ASSET_FEEDS)),
        ("exposures", lambda: jobs.daily(EXPOSURE_FEED)),
        ("covariances", lambda: jobs.daily(COVARIANCE_FEED)),
        ("factor_returns", lambda: jobs.latest(FACTOR_RETURN_FEED)),
        ("maps", jobs.map_intervals),
    ])


def risk_model_backfill(
    jobs: VendorJobs, start: date = RISK_MODEL_START, end: date | None = None, clip: bool = False, run: str | None = None
) -> None:
    """As the daily jobs from the history archives; factor returns have none."""
    end = end or jobs.today
    run_steps(jobs.store, run, [
        ("assets", lambda: jobs.history(start, end, *ASSET_FEEDS, clip=clip)),
        ("exposures", lambda: jobs.history(start, end, EXPOSURE_FEED, clip=clip)),
        ("covariances", lambda: jobs.history(start, end, COVARIANCE_FEED, clip=clip)),
        ("maps", jobs.map_intervals),
    ])


def price_backfill(
    store: PanelStore, events, monthly, daily, end: date, start: date = PRICE_HISTORY_START
) -> None:
    """``events``, ``monthly`` and ``daily`` are sources for ``read_range``."""
    prices.events(store, events, start, end)
    prices.monthly(store, monthly, start, end)
    prices.daily(store, daily, start, end)


def index_backfill(store: PanelStore, holdings, end: date, start: date = RISK_MODEL_START) -> None:
    index.backfill(store, holdings, start, end)
