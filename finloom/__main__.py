"""Runs daily jobs: python -m finloom BASE DATABASE AS_OF [JOB ...]

AS_OF is the UTC moment to run for, such as 2025-03-25T12:00:00. The cluster's
spark-defaults give the master and spark.checkpoint.dir. Without job names all run.
"""

from __future__ import annotations

import datetime as dt
import sys

from finloom.plans import jobs
from finloom.session import build_session

JOBS = {
    job.__name__: job
    for job in (
        jobs.extract_articles,
        jobs.extract_events,
        jobs.extract_earnings,
        jobs.load_articles,
        jobs.load_events,
        jobs.load_earning_calls,
        jobs.load_earning_star,
        jobs.write_digests,
        jobs.mail_of_run,
        jobs.messages_of_run,
        jobs.register_arrived,
        jobs.sweep_store,
    )
}


def run(store: jobs.Store, as_of: dt.datetime, names: list[str]) -> dict[str, object]:
    unknown = [n for n in names if n not in JOBS]
    if unknown:
        raise ValueError(f"unknown jobs {unknown}; there are {list(JOBS)}")
    return {name: JOBS[name](store, as_of) for name in names}


def main(arguments: list[str]) -> None:
    base, database, as_of, *names = arguments
    spark = build_session("finloom")
    results = run(jobs.Store(spark, base, database), dt.datetime.fromisoformat(as_of), names or list(JOBS))
    for name, result in results.items():
        print(name, result)
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
