"""Command line: ``python -m docquarry.cli VERB ...``; a cluster runs it by spark-submit."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import SparkSession

from .functions import text
from .operators import infer, preflight
from .plans import run as verbs
from .ship import ship
from .sources import files
from .store import CorpusStore


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="docquarry", description=__doc__)
    sub = top.add_subparsers(dest="verb", required=True)
    arguments = {
        "--store": {"default": "corpus", "help": "folder of the corpus store"},
        "--input-dir": {"default": "input/demo_corpus"},
        "--prompts-dir": {"default": "prompts"},
        "--system-prompt": {"default": "system_prompt.txt"},
        "--output-dir": {"default": "out"},
        "--server-url": {"default": "", "help": "chat server; without one the rule backend answers"},
        "--concurrency": {"type": int, "required": True},
        "--limit": {"type": int, "default": 0},
        "--model": {"default": "rules"},
        "--delete": {"action": "store_true"},
        "--on-change": {"choices": ["error", "replace"], "default": "error"},
        "--url": {"action": "append", "dest": "urls"},
        "--partitions": {"type": int, "help": "deal the pairs out to so many tasks"},
        "--wave": {"type": int, "default": verbs.InferenceConfig.wave, "help": "pairs whose replies are saved together"},
        "--min-length": {"type": int, "help": "least characters of a valid body"},
        "--min-printable": {"type": float, "help": "least share of printable characters of a valid body"},
    }
    takes = {
        "fetch": ["--url", "--input-dir"],
        "prep-db": ["--store", "--input-dir", "--prompts-dir", "--on-change", "--min-length", "--min-printable"],
        "preflight": ["--store", "--delete", "--min-length", "--min-printable"],
        "process": ["--store", "--prompts-dir", "--system-prompt", "--output-dir", "--server-url", "--concurrency", "--limit", "--model", "--partitions", "--wave"],
        "import-results": ["--store", "--output-dir"],
        "run": ["--store", "--url", "--input-dir", "--prompts-dir", "--system-prompt", "--output-dir", "--server-url", "--concurrency", "--model", "--partitions", "--wave", "--min-length", "--min-printable"],
    }
    for verb, names in takes.items():
        own = sub.add_parser(verb)
        for name in names:
            own.add_argument(name, **arguments[name])
    return top


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    """Exit status: 1 for failed URLs, for bad documents that stay, and for missing inputs."""
    a = parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("docquarry").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    ship(spark)
    status = 0
    if a.verb == "fetch":
        out = verbs.fetch(spark, a.input_dir, a.urls)
        status = int(out["failed"] > 0)
    else:
        store = CorpusStore(spark, a.store)
        for name, (setting, _) in text.SETTINGS.items():
            if getattr(a, name, None) is not None:
                spark.conf.set(setting, str(getattr(a, name)))
        config = verbs.InferenceConfig(**{k: getattr(a, k) for k in ("model", "concurrency", "partitions", "wave") if hasattr(a, k)})
        backend = infer.Http(a.server_url) if getattr(a, "server_url", "") else infer.Rules()
        if a.verb == "prep-db":
            out = verbs.prep_db(store, a.input_dir, a.prompts_dir, on_change=a.on_change)
        elif a.verb == "preflight":
            out = preflight.run(store, a.delete)
            status = int(out["problematic"] > 0 and not a.delete)
        elif a.verb == "process":
            out = verbs.process(store, a.prompts_dir, files.system_prompt(spark, a.system_prompt), a.output_dir, backend, config, a.limit)
        elif a.verb == "import-results":
            out = verbs.import_results(store, a.output_dir)
        else:
            fetched = verbs.fetch(spark, a.input_dir, a.urls)  # failed URLs are told, but end nothing here
            out = {"fetch": fetched} | verbs.run(store, a.input_dir, a.prompts_dir, files.system_prompt(spark, a.system_prompt), a.output_dir, backend, config)
    print(json.dumps(out, default=str, indent=2))
    return status


if __name__ == "__main__":
    sys.exit(main())
