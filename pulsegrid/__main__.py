"""`python -m pulsegrid NAME --setting value ...` runs a pipeline; `--help` lists names and settings."""

from __future__ import annotations

import argparse
import dataclasses
import json
import logging

from pyspark.sql import SparkSession

from pulsegrid.plans.pipelines import PIPELINES
from pulsegrid.sources.readers import UTC


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="pulsegrid", description=__doc__)
    names = top.add_subparsers(dest="name", required=True)
    for name, kind in PIPELINES.items():
        one = names.add_parser(name, help=(kind.__doc__ or "").strip().splitlines()[0])
        for f in dataclasses.fields(kind):
            if f.type.startswith("Callable"):
                continue
            required = f.default is dataclasses.MISSING and f.default_factory is dataclasses.MISSING
            default = None if required else f.default_factory() if f.default_factory is not dataclasses.MISSING else f.default
            how = {"action": argparse.BooleanOptionalAction} if f.type == "bool" else {"type": json.loads if f.type.startswith("dict") else int if f.type.startswith("int") else str}
            one.add_argument("--" + f.name.replace("_", "-"), dest=f.name, required=required, default=default, **how)
    return top


def main(argv: list[str] | None = None) -> None:
    settings = vars(parser().parse_args(argv))
    pipeline = PIPELINES[settings.pop("name")](**settings)
    logging.basicConfig(level=logging.INFO)
    spark = SparkSession.builder.appName("pulsegrid").config(UTC, "UTC").getOrCreate()
    spark.conf.set(UTC, "UTC")
    pipeline.run(spark)


if __name__ == "__main__":
    main()
