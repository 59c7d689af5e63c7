"""Registered queries over the driver tables, with their SQL oracles."""

import importlib
import time

GROUPS = ("columns", "flattening", "tables", "matches", "reporting", "searching", "queue_jobs", "scans", "streams")


def load() -> None:
    """Import every group, which registers its queries."""
    for group in GROUPS:
        importlib.import_module(f"vellum.plans.{group}")


def stage(spark, sf_dir: str) -> dict[str, float]:
    """Build the derived tables, snapshot and indexes that queries read, so that timings leave them out; seconds of each."""
    from vellum.plans import nested, scans, searching

    seconds = {}
    for build in (nested.nested_works, nested.inverted_works, nested.torn_works, searching.postings, searching.full_postings,
                  searching.stems, searching.text_index, scans.published_snapshot):
        started = time.perf_counter()
        build(spark, sf_dir)
        seconds[build.__name__] = round(time.perf_counter() - started, 3)
    return seconds
