"""python -m pagemill pages|blocks|gold key=value ...: runs a job; wrong arguments are logged, and the exit code is 1."""

from __future__ import annotations

import logging
import sys

from pagemill.config import GoldConfig, PackConfig, PageConfig, from_arguments

USAGE = "usage: python -m pagemill pages|blocks|gold key=value ..."


def main(arguments: list[str], spark=None) -> int:
    logging.basicConfig(level=logging.INFO, format="[%(asctime)s] %(message)s", datefmt="%H:%M:%S")
    log = logging.getLogger("pagemill")
    kinds = {"pages": PageConfig, "blocks": PackConfig, "gold": GoldConfig}
    try:
        name, *rest = arguments or [""]
        if name not in kinds:
            raise TypeError(f"unknown job: {name}")
        config = from_arguments(kinds[name], rest)
    except TypeError as e:
        log.error("%s\n\n%s", e, USAGE)
        return 1
    from pyspark.sql import SparkSession

    from pagemill.plans import jobs

    found = getattr(jobs, f"build_{name}")(spark or SparkSession.builder.getOrCreate(), config)
    log.info("%s: %s", name, ", ".join(f"{k} {v}" for k, v in sorted(found.items())))
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
