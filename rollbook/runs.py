"""Run protocol: years that are done are skipped, a run is complete when every year passes."""

from __future__ import annotations

import json
import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

#: Tables a year must have, each as Parquet and as CSV; its status is the remaining file.
REQUIRED = tuple(f"{t}{kind}" for t in ("facilities", "facility_services", "service_availability") for kind in ("", "_csv"))
STATUS = "directory_year int, state string, signature string, structural_pass boolean, blocking_reasons string, error string, runtime_seconds double"


def status_of(run: Path, year: int) -> dict:
    """The status written for a year, or {}."""
    path = run / "status" / f"{year}.json"
    return json.loads(path.read_text()) if path.exists() else {}


def absent_tables(run: Path, year: int) -> list[str]:
    return [t for t in REQUIRED if not (run / t / f"directory_year={year}").exists()]


def is_resumable(run: Path, year: int, signature: str) -> bool:
    """Whether a year finished under the same inputs and code and its tables are there."""
    s = status_of(run, year)
    return s.get("state") == "complete" and s.get("signature") == signature and s.get("structural_pass", False) and not absent_tables(run, year)


def selected(years: list[int], first: int | None = None, last: int | None = None, only: set[int] | None = None) -> list[int]:
    """The years asked for, in order; one that the manifest lacks raises."""
    if unknown := sorted((only or set()) - set(years)):
        raise ValueError(f"years absent from the manifest: {', '.join(map(str, unknown))}")
    return [y for y in sorted(years) if (first is None or y >= first) and (last is None or y <= last) and (not only or y in only)]


def run_years(run: Path, years: list[int], signature: str, work: Callable[[int], dict], resume: bool = True, workers: int = 1) -> dict[int, dict]:
    """Runs ``work`` for each year that isn't done, ``workers`` at a time; a failure is recorded and the others go on.

    The threads only submit jobs: Spark shares its executors among them.
    """
    (run / "status").mkdir(parents=True, exist_ok=True)

    def one(year: int) -> dict:
        if resume and is_resumable(run, year, signature):
            return status_of(run, year)
        began = time.time()
        try:
            metrics = {"state": "complete"} | work(year)
        except Exception as error:  # recorded; validate() reports it
            metrics = {"state": "failed", "error": str(error)[:2000], "structural_pass": False}
        metrics |= {"directory_year": year, "signature": signature, "runtime_seconds": round(time.time() - began, 3)}
        (run / "status" / f"{year}.json").write_text(json.dumps(metrics, indent=2))
        return metrics

    with ThreadPoolExecutor(max_workers=workers) as pool:
        out = dict(zip(years, pool.map(one, years), strict=True))
    (run / "run.json").write_text(json.dumps({"run_id": run.name, "signature": signature, "years": years, "workers": workers, "complete": validate(run, years)["complete"]}, indent=2))
    return out


def read_status(spark: SparkSession, run: Path) -> DataFrame:
    """One row a year of what the run's status files say."""
    return spark.read.schema(STATUS).option("multiLine", True).json(str(run / "status")).orderBy("directory_year")


def validate(run: Path, years: list[int]) -> dict:
    """Which years are missing, failed, blocked or lack a table; complete only if none is."""
    states = {y: status_of(run, y) for y in years}
    done = [y for y, s in states.items() if s.get("state") == "complete"]
    bad = {
        "missing": [y for y, s in states.items() if not s],
        "failed": [y for y, s in states.items() if s.get("state") == "failed"],
        "incomplete": [y for y in done if absent_tables(run, y)],
        "blocked": [y for y in done if not states[y].get("structural_pass")],
    }
    return bad | {"complete": not any(bad.values())}


def latest_run(folder: Path) -> Path:
    """The last run folder by name."""
    runs = sorted(p for p in folder.iterdir() if (p / "status").exists())
    if not runs:
        raise FileNotFoundError(f"no run in {folder}")
    return runs[-1]
