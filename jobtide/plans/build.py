"""Landing a run and building the layers from the landing table."""

from __future__ import annotations

import datetime as dt
import hashlib
import logging
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobtide import fixed
from jobtide.plans import marts, responses, suites
from jobtide.plans.normalize import normalize
from jobtide.plans.staging import StoredStaging
from jobtide.sources import versions
from jobtide.sources.marts import Marts, read_folder, write_mart
from jobtide.schemas import FAILURES, RAW, RUNS
from jobtide.sources.raw import Landing, as_raw, landings, read_raw, read_runs
from jobtide.sources.seeds import read_rates
from jobtide.sources.workdir import written

logger = logging.getLogger(__name__)

MODELS = {
    "staging": tuple(f"stg_{source}_jobs" for source in fixed.SOURCES),
    "intermediate": ("int_jobs_normalized",),
    "marts": ("mart_skills", "mart_salary_ranges", "mart_companies", "mart_jobs_over_time"),
}


#: Failed runs named in the error of a landing; the log names all.
RUNS_NAMED = 100


#: What each model is made from.
DEPENDS = {
    **{f"stg_{source}_jobs": (f"raw_{source}_jobs",) for source in fixed.SOURCES},
    "int_jobs_normalized": (*MODELS["staging"], "exchange_rates"),
    "mart_skills": ("int_jobs_normalized",),
    "mart_salary_ranges": ("int_jobs_normalized",),
    "mart_companies": ("int_jobs_normalized",),
    "mart_jobs_over_time": ("int_jobs_normalized", "mart_skills"),
}


class RunError(RuntimeError):
    """Raised when runs were there to land and every one of them failed."""


def unlanded(landed: DataFrame, raw_path: str, settled: dt.datetime | None = None) -> DataFrame:
    """Responses of runs that the log does not know; with ``settled``, of runs that ended before it."""
    known = read_runs(landed.sparkSession, raw_path)
    if known is not None:
        landed = landed.join(known.select("source", "run_id").distinct(), ["source", "run_id"], "left_anti")
    if settled is not None:
        ended = landed.groupBy("source", "run_id").agg(F.max("fetched_at").alias("_ended")).where(F.col("_ended") < settled)
        landed = landed.join(ended.drop("_ended"), ["source", "run_id"], "left_semi")
    return landed


def stage_landing(
    landed: DataFrame,
    raw_path: str,
    sources: Sequence[str] | None = None,
    now: dt.datetime | None = None,
    work: str | None = None,
    feeds: Mapping[str, responses.Feed] = responses.FEEDS,
    settled: dt.datetime | None = None,
) -> tuple[Landing, DataFrame, DataFrame]:
    """Write what there is to land, without committing it: the landing, its payloads and its runs.

    Bodies are parsed once, into the stored classification that everything else starts from. The payloads
    of each source are written to its folder; what a run landed is counted from the columns of the rows written.
    """
    names = responses.known_sources(fixed.SOURCES if sources is None else sources)
    now = now or dt.datetime.now(dt.UTC)
    new = unlanded(landed.where(F.col("source").isin(names)), raw_path, settled)
    landing = Landing.begin(landed.sparkSession, raw_path)
    packed, logged, failed = {}, [], []
    for number, name in enumerate(names):
        feed = feeds[name]
        classified = written(responses.classify(new.where(F.col("source") == name), feed), f"classified-{name}", work=work)
        requests = responses.outcomes(classified, feed)
        places = written(responses.chunk_places(requests, feed), f"places-{name}", work=work)
        place = F.col("place") * len(names) + number  # ids of one source do not meet those of another
        rows = responses.payloads(classified, feed).join(places, list(responses.CHUNK)).withColumn("place", place)
        packed[name] = as_raw(rows, landing.base, now)
        counts = responses.run_counts(requests, feed)
        failed.append(responses.failures(requests, counts, feed))
        logged.append(counts.join(responses.run_times(requests), "run_id"))
    union = DataFrame.unionByName
    payloads = landing.write(packed, RAW)
    failures = landing.write(reduce(union, failed), FAILURES, ".failures")
    errors = [responses.error_texts(failures.where(F.col("source") == n), feeds[n]).withColumn("source", F.lit(n)) for n in names]
    key = ["source", "run_id"]
    stored = payloads.groupBy(*key).agg(F.count("*").alias("payloads"), F.sum("job_count").alias("job_count"))
    runs = reduce(union, logged).join(stored, key, "left").join(reduce(union, errors), key, "left")
    filled = {
        "ingested_at": F.coalesce("ingested_at", F.lit(now)),
        "payloads": F.coalesce("payloads", F.lit(0)),
        "job_count": F.coalesce("job_count", F.lit(0)),
    }
    return landing, payloads, landing.write(runs.withColumns(filled), RUNS, ".runs")


def land(
    landed: DataFrame,
    raw_path: str,
    sources: Sequence[str] | None = None,
    now: dt.datetime | None = None,
    work: str | None = None,
    feeds: Mapping[str, responses.Feed] = responses.FEEDS,
    settled: dt.datetime | None = None,
) -> DataFrame:
    """Land every run that has not been landed yet, and return a row for each, failed ones included.

    The same rows are the log beside the landing table, by which later calls skip them; payloads and log
    are committed together, so that a call that broke off is as if it had not been. A run has to be complete
    when it is landed; ``settled`` leaves out those that still received responses at that time or later.
    Raises, after the commit, if there were runs and none went well.
    """
    landing, payloads, runs = stage_landing(landed, raw_path, sources, now, work, feeds, settled)
    tally = runs.groupBy("source").agg(F.count("*").alias("n"), F.count_if(F.col("status") == "succeeded").alias("good")).collect()
    total = sum(r["n"] for r in tally)
    if not total:
        return runs
    landing.commit(payloads, total, now)
    if not any(r["good"] for r in tally):
        worst = runs.orderBy("source", "ingested_at", "run_id").limit(RUNS_NAMED).collect()
        listed = "; ".join(f"{r['source']} {r['run_id']}: {r['error']}" for r in worst)
        by_source = ", ".join(f"{r['source']} {r['n']}" for r in sorted(tally))
        raise RunError(f"none of {total} run(s) could be landed ({by_source}; all are listed in {raw_path}.runs): {listed}")
    return runs


def _digest(*parts: object) -> str:
    return hashlib.sha256(repr(parts).encode()).hexdigest()


@dataclass
class Build:
    """The layers over one landing table. Staging and unified postings are views, marts are tables.

    Every model names what it is made from (:data:`DEPENDS`), and its fingerprint follows from those of
    its inputs: the landings committed, and the rates. Stored staging rows and marts carry the fingerprint they
    were made at, and are left alone where it still holds. The unified postings are stored for the
    length of a build, if a mart is to be made from them. ``work`` is a folder that all executors share; without
    one it is that of ``spark.checkpoint.dir``.
    """

    spark: SparkSession
    raw_path: str
    mart_folder: str
    rates: DataFrame | None = None
    lenient: bool = False
    work: str | None = None
    #: The marts that the last run wrote.
    written: list[str] = field(default_factory=list)
    _staged: dict[str, tuple[str, DataFrame]] = field(default_factory=dict, repr=False)

    def table(self, name: str) -> DataFrame:
        """Any table of the build by name."""
        if name == "raw":
            return read_raw(self.spark, self.raw_path)
        if name == "exchange_rates":
            return self._rates()
        if name in MODELS["staging"]:
            return self._stage(name)
        if name == "int_jobs_normalized":
            return normalize(*[self.table(stage) for stage in MODELS["staging"]], self._rates())
        if name in MODELS["marts"]:
            return versions.read(self.spark, f"{self.mart_folder}/{name}")
        raise ValueError(f"Unknown table {name!r}")

    def fingerprints(self) -> dict[str, str]:
        """What each model follows from, inputs first."""
        rows = self._rates()
        hashed = rows.agg(F.sum(F.xxhash64(*rows.columns).cast("decimal(38,0)")), F.count("*")).first()
        known = {"exchange_rates": _digest(*hashed)}
        for source in fixed.SOURCES:
            known[f"raw_{source}_jobs"] = _digest(landings(self.spark, self.raw_path, source))
        for name in TopologicalSorter(DEPENDS).static_order():
            if name in DEPENDS:
                known[name] = _digest(name, self.lenient, [known[i] for i in DEPENDS[name]])
        return known

    def _stage(self, name: str) -> DataFrame:
        """Stored staging rows, brought up to date where landings were committed since."""
        source = name.split("_")[1]
        fingerprint = _digest(name, self.lenient, landings(self.spark, self.raw_path, source))
        if self._staged.get(source, (None,))[0] != fingerprint:
            path = f"{self.mart_folder}/staging/{name}{'-lenient' if self.lenient else ''}"
            stored = StoredStaging(read_raw(self.spark, self.raw_path, source), path, source, self.lenient)
            self._staged[source] = fingerprint, stored.rows(stored.refresh(fingerprint))
        return self._staged[source][1]

    def _rates(self) -> DataFrame:
        if self.rates is None:
            self.rates = read_rates(self.spark)
        return self.rates

    def run(self, select: Sequence[str] | None = None, full_refresh: bool = False) -> list[str]:
        """Bring the chosen layers or models up to date, all by default, and return their names.

        A mart whose inputs did not change is not written again, unless a full refresh is asked for;
        ``written`` names those that were.
        """
        chosen = list(MODELS) if select is None else list(select)
        wanted = [name for item in chosen for name in MODELS.get(item, (item,))]
        every = [name for names in MODELS.values() for name in names]
        unknown = [name for name in wanted if name not in every]
        if unknown:
            raise ValueError(f"Unknown layer(s) or model(s) {unknown}; expected {list(MODELS)} or {every}")
        models = [name for name in TopologicalSorter(DEPENDS).static_order() if name in wanted]
        for name in models:
            if name not in MODELS["marts"]:
                self.table(name).createOrReplaceTempView(name)
        known = self.fingerprints()
        self.written = [name for name in models if name in MODELS["marts"] and (full_refresh or self._stored(name) != known[name])]
        if self.written:
            self._marts(self.written, known)
        return models

    def _stored(self, name: str) -> str | None:
        """The fingerprint a mart was made at."""
        version = versions.current(self.spark, f"{self.mart_folder}/{name}")
        return version and version.fingerprint

    def _marts(self, names: Sequence[str], known: Mapping[str, str]) -> None:
        jobs = written(self.table("int_jobs_normalized"), "int_jobs_normalized", work=self.work)
        models = {
            "mart_skills": lambda: marts.mart_skills(jobs),
            "mart_salary_ranges": lambda: marts.mart_salary_ranges(jobs),
            "mart_companies": lambda: marts.mart_companies(jobs),
            "mart_jobs_over_time": lambda: marts.mart_jobs_over_time(jobs, self._skills(jobs, known)),
        }
        for name in names:
            write_mart(name, models[name](), folder=self.mart_folder, fingerprint=known[name])

    def _skills(self, jobs: DataFrame, known: Mapping[str, str]) -> DataFrame:
        """The skills mart where it is up to date, or its rows where it is not part of this build."""
        return self.table("mart_skills") if self._stored("mart_skills") == known["mart_skills"] else marts.mart_skills(jobs)

    def check(
        self, now: dt.datetime | None = None, checks: Sequence[suites.Check] = suites.CHECKS
    ) -> list[suites.CheckResult]:
        """Run the checks over the layers as they stand."""
        return suites.run_checks(self.table, now, checks)

    def check_models(self) -> list[suites.CheckResult]:
        """Run what the models declare about themselves."""
        return suites.run_model_checks(self.table)

    def marts(self) -> Marts:
        """The stored marts, typed."""
        return read_folder(self.spark, self.mart_folder)


def full_run(
    landed: DataFrame,
    raw_path: str,
    mart_folder: str,
    sources: Sequence[str] | None = None,
    now: dt.datetime | None = None,
    work: str | None = None,
) -> DataFrame:
    """Land, build and check; raises if all runs or any check failed. Returns the runs landed."""
    runs = land(landed, raw_path, sources, now, work)
    build = Build(landed.sparkSession, raw_path, mart_folder, work=work)
    build.run()
    done = build.check(now)
    logger.info("%s", suites.format_report(done))
    suites.gate(done)
    return runs
