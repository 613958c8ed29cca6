"""Stages in order, each behind a switch of the configuration, and the command line that runs them.

    python -m hexpanel.runner --config conf.yaml --stages my.module:STAGES [--task T] [--base-year Y] [key=value ...]
"""

from __future__ import annotations

import argparse
import importlib
import json
import logging
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import SparkSession

from hexpanel import config
from hexpanel.session import build_session
from hexpanel.sinks import quote, setup_logging


@dataclass(frozen=True)
class Stage:
    """A step; it runs where every switch (dotted keys of the configuration) is on."""

    name: str
    run: Callable[[SparkSession, dict], Any]
    switches: tuple[str, ...] = ()


def run_stages(spark: SparkSession, cfg: dict, stages: Sequence[Stage], log: logging.Logger | None = None) -> dict[str, Any]:
    """Results by name of the stages that are switched on. A failure is logged and raised, so no later stage runs."""
    log, out = log or logging.getLogger("hexpanel"), {}
    for stage in stages:
        if not all(config.select(cfg, key, False) for key in stage.switches):
            log.info("%s: switched off", stage.name)
            continue
        began = time.time()
        log.info("%s: begins", stage.name)
        try:
            out[stage.name] = stage.run(spark, cfg)
        except Exception:
            log.exception("%s: failed after %.1f s", stage.name, time.time() - began)
            raise
        log.info("%s: done in %.1f s", stage.name, time.time() - began)
    return out


def open_warehouse(cfg: dict) -> SparkSession:
    """A session by the `spark` part of the configuration (app, master, settings), with the databases that it names."""
    part = config.select(cfg, "spark", {}) or {}
    spark = build_session(part.get("app", "hexpanel"), part.get("master"), part.get("shuffle_partitions"), part.get("settings"))
    for name in part.get("databases", ()):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quote(name)}")
    return spark


def report(metrics: dict[str, dict], path: str | None = None) -> str:
    """Metrics of models by name as JSON text, in order of names; written to a local file where one is named."""
    text = json.dumps(metrics, indent=1, sort_keys=True, ensure_ascii=False, default=float)
    if path:
        with open(path, "w") as f:
            f.write(text)
    return text


def arguments(argv: Sequence[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="hexpanel")
    p.add_argument("--config", required=True)
    p.add_argument("--stages", help="module:name of a list of stages")
    p.add_argument("--task")
    p.add_argument("--base-year", type=int)
    p.add_argument("overrides", nargs="*", help="key=value")
    return p.parse_args(argv)


def main(argv: Sequence[str] | None = None) -> dict[str, Any]:
    args = arguments(argv)
    cfg = config.resolve(config.load(args.config, args.overrides))
    for key, value in (("task", args.task), ("base_year", args.base_year)):
        if value is not None:
            cfg[key] = value
    log = setup_logging(config.select(cfg, "logging.directory"), level=config.select(cfg, "logging.level", "INFO"))
    stages: Sequence[Stage] = ()
    if args.stages:
        module, _, name = args.stages.partition(":")
        stages = getattr(importlib.import_module(module), name or "STAGES")
    return run_stages(open_warehouse(cfg), cfg, stages, log)


if __name__ == "__main__":
    main()
