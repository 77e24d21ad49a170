"""Command line of the three batch jobs, for ``spark-submit`` or ``python -m tillroll.run``.

    tillroll.run clean     --retail-source S --cleaned-output-path P
    tillroll.run enrich    --cleaned-input-path P --enriched-output-path P
    tillroll.run aggregate --enriched-input-path P --retail-source S ...

The arguments are the fields of the job's configuration; a source is a path or
``catalog:database.table``.
"""

from __future__ import annotations

import argparse
from dataclasses import MISSING, fields

from tillroll.config import AggregationJobConfig, CleaningJobConfig, EnrichJobConfig
from tillroll.plans.jobs import run_aggregation_job, run_cleaning_job, run_enrich_job
from tillroll.session import get_spark

JOBS = {
    "clean": (CleaningJobConfig, run_cleaning_job),
    "enrich": (EnrichJobConfig, run_enrich_job),
    "aggregate": (AggregationJobConfig, run_aggregation_job),
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tillroll.run", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    jobs = top.add_subparsers(dest="job", required=True)
    for name, (config, _) in JOBS.items():
        job = jobs.add_parser(name)
        for f in fields(config):
            if f.name == "rules":
                continue  # the rules have their defaults here; a program may pass others
            if f.type == "bool":
                job.add_argument("--" + f.name.replace("_", "-"), dest=f.name, action="store_true")
                continue
            optional = "None" in str(f.type)
            default = None if f.default is MISSING else f.default
            kind = int if f.type == "int" else str
            job.add_argument("--" + f.name.replace("_", "-"), dest=f.name, type=kind, default=default, required=f.default is MISSING and not optional)
    return top


def main(args: list[str] | None = None, spark=None) -> None:
    given = vars(parser().parse_args(args))
    config, run = JOBS[given.pop("job")]
    audit = run(spark or get_spark(app_name="tillroll"), config(**given))
    for row in audit.collect():  # the audit: a dozen counters
        print(f"{row['step']}: {row['row_count']}")


if __name__ == "__main__":
    main()
