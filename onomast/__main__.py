"""python -m onomast --config settings.yaml [--max-records N] [--continue]"""

from __future__ import annotations

import argparse
import json
from dataclasses import asdict

from onomast.config import Settings
from onomast.operators.ner import recogniser
from onomast.plans.resolve import Summary, run


def settings_of(path: str) -> Settings:
    """Settings from a JSON file or, where PyYAML is installed, a YAML file."""
    if path.endswith(".json"):
        with open(path, encoding="utf-8") as f:
            return Settings.from_dict(json.load(f))
    return Settings.from_yaml(path)


def main(arguments: list[str] | None = None) -> Summary:
    from pyspark.sql import SparkSession

    parser = argparse.ArgumentParser(prog="onomast", description="Resolve names in records into entities.")
    parser.add_argument("--config", required=True, help="settings, YAML or JSON")
    parser.add_argument("--max-records", type=int, default=None, help="take so many valid records at most")
    parser.add_argument("--continue", dest="resume", action="store_true", help="leave out records of earlier runs")
    given = parser.parse_args(arguments)
    settings = settings_of(given.config)
    settings.processing.resume = settings.processing.resume or given.resume
    if given.max_records is not None:
        settings.processing.max_records = given.max_records
    summary = run(SparkSession.builder.appName("onomast").getOrCreate(), settings, recogniser(settings.processing.recogniser))
    print(json.dumps(asdict(summary) | {"total": summary.total, "per_second": round(summary.per_second, 1)}))
    return summary


if __name__ == "__main__":
    main()
