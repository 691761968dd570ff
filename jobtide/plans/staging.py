"""Staging: one row per posting of a source, from its newest payload."""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobtide.functions.json import document_of
from jobtide.functions.text import flag, null_if
from jobtide.functions.time import convert, utc_from_naive
from jobtide.operators.dedup import latest_by_key
from jobtide.schemas import AMOUNT
from jobtide.sources import versions

AMOUNT_TYPE = AMOUNT.simpleString()


def explode_jobs(raw: DataFrame) -> DataFrame:
    """One row per posting of each payload, a variant, with its place in the payload.

    Landing has parsed the payload; here only what is asked for is taken out of it. A payload whose
    ``jobs`` is no list gives no rows. They are dropped after an outer explode: from an inner one a
    filter on the list is inferred, which takes the list out once more.
    """
    payload = raw.withColumn("_d", document_of(raw)).withColumn("search_country", F.try_variant_get("_d", "$.country", "string"))
    return payload.select(
        "raw_id",
        "ingested_at",
        "source",
        "search_country",
        F.posexplode_outer(F.try_variant_get("_d", "$.jobs", "array<variant>")).alias("position", "job"),
    ).where(F.col("position").isNotNull())


def _absent(kind: str) -> Column:
    return F.lit(None).cast(kind)


def _remotive(job: Callable[[str], Column], lenient: bool) -> dict[str, Column]:
    return {
        "title": job("title"),
        "company": job("company_name"),
        "category": job("category"),
        "tags": job("tags"),
        "location": job("candidate_required_location"),
        "salary_min": _absent(AMOUNT_TYPE),
        "salary_max": _absent(AMOUNT_TYPE),
        "salary_text": null_if(job("salary"), ""),
        "published_at": utc_from_naive(job("publication_date"), lenient),
        "url": job("url"),
    }


def _remoteok(job: Callable[[str], Column], lenient: bool) -> dict[str, Column]:
    # Numbers come as text; "0" means not provided.
    return {
        "title": job("position"),
        "company": job("company"),
        "category": _absent("string"),
        "tags": job("tags"),
        "location": null_if(job("location"), ""),
        "salary_min": convert(null_if(job("salary_min"), "0"), AMOUNT_TYPE, lenient),
        "salary_max": convert(null_if(job("salary_max"), "0"), AMOUNT_TYPE, lenient),
        "salary_text": _absent("string"),
        "published_at": convert(job("date"), "timestamp", lenient),
        "url": job("url"),
    }


def _adzuna(job: Callable[[str], Column], lenient: bool) -> dict[str, Column]:
    return {
        "title": job("title"),
        "company": job("company.display_name"),
        "category": job("category.label"),
        "tags": _absent("array<string>"),
        "location": job("location.display_name"),
        "salary_min": convert(job("salary_min"), AMOUNT_TYPE, lenient),
        "salary_max": convert(job("salary_max"), AMOUNT_TYPE, lenient),
        "salary_text": _absent("string"),
        "salary_is_predicted": flag(job("salary_is_predicted")),
        "published_at": convert(job("created"), "timestamp", lenient),
        "url": job("redirect_url"),
        "search_country": F.col("search_country"),
    }


FIELDS = {"remotive": _remotive, "remoteok": _remoteok, "adzuna": _adzuna}


def _field(name: str) -> Column:
    """A field of a posting as text, or its list of texts; casts happen later, where a bad value can be told apart."""
    return F.try_variant_get("job", f"$.{name}", "array<string>" if name == "tags" else "string")


def parse_jobs(raw: DataFrame, source: str, lenient: bool = False) -> DataFrame:
    """Every posting of every payload of one source, typed; bad numbers and dates raise unless lenient."""
    jobs = explode_jobs(raw.where(F.col("source") == source))
    columns = FIELDS[source](_field, lenient)
    return jobs.select(
        _field("id").alias("job_id"),
        "source",
        *[column.alias(name) for name, column in columns.items()],
        "ingested_at",
        "raw_id",
        "position",
    )


NEWEST = ["ingested_at", "raw_id", "position"]
#: Columns that only order versions; stored staging rows keep them.
ORDERED = ("position",)


def staging(raw: DataFrame, source: str, lenient: bool = False, ordered: bool = False) -> DataFrame:
    """The newest version of each posting of one source: of the latest run, and there of the latest place."""
    newest = latest_by_key(parse_jobs(raw, source, lenient), ["job_id"], NEWEST)
    return newest if ordered else newest.drop(*ORDERED)


#: Buckets of stored staging rows by posting, and parts of a bucket on one level that are merged into the next.
BUCKETS, MERGED = 32, 4


def bucket_of(job_id: Column) -> Column:
    return F.pmod(F.xxhash64(job_id), F.lit(BUCKETS)).cast("int")


class StoredStaging:
    """The newest version of each posting of one source, stored in parts that are merged on reading.

    Payloads appended since are parsed alone (raw ids grow) and become a part of each bucket that they touch;
    no other is written. A bucket with :data:`MERGED` parts on one level has them merged into one of the next
    level, so that a posting is rewritten once a level and a bucket is read from few parts. Rows of one part
    need no merging.
    """

    def __init__(self, raw: DataFrame, path: str, source: str, lenient: bool = False):
        self.spark, self.raw, self.path, self.source, self.lenient = raw.sparkSession, raw, path, source, lenient
        self.schema = parse_jobs(raw, source, lenient).schema

    def refresh(self, fingerprint: str) -> versions.Version:
        """Bring the stored rows up to the payloads there are; nothing is written if the fingerprint is that stored."""
        last = versions.current(self.spark, self.path)
        if last is not None and last.fingerprint == fingerprint:
            return last
        seen, parts = (last.upto, list(last.parts)) if last else (0, [])
        upto = self.raw.agg(F.max("raw_id")).first()[0] or 0
        new = parse_jobs(self.raw.where((F.col("raw_id") > seen) & (F.col("raw_id") <= upto)), self.source, self.lenient)
        parts += self._write(latest_by_key(new, ["job_id"], NEWEST), 0)
        level = 0
        while any(p.level >= level for p in parts):
            on_level: dict[int, list[versions.Part]] = {}
            for p in parts:
                if p.level == level:
                    on_level.setdefault(p.bucket, []).append(p)
            full = [p for of_bucket in on_level.values() if len(of_bucket) >= MERGED for p in of_bucket]
            if full:
                parts = [p for p in parts if p not in full] + self._write(self._merged(full), level + 1)
            level += 1
        return versions.publish(self.spark, self.path, parts, fingerprint, upto)

    def _write(self, rows: DataFrame, level: int) -> list[versions.Part]:
        folder = versions.new_folder()
        rows.withColumn("bucket", bucket_of(F.col("job_id"))).repartition("bucket").write.partitionBy("bucket").parquet(f"{self.path}/{folder}")
        written = self.spark.read.schema("bucket int").parquet(f"{self.path}/{folder}").select("bucket").distinct().collect()
        return [versions.Part(folder, r["bucket"], level) for r in written]

    def _merged(self, parts: list[versions.Part]) -> DataFrame:
        return latest_by_key(versions.read_buckets(self.spark, self.path, parts, self.schema).drop("bucket"), ["job_id"], NEWEST)

    def rows(self, version: versions.Version) -> DataFrame:
        """The staging view, as of a version."""
        several = {b for b, n in Counter(p.bucket for p in version.parts).items() if n > 1}
        alone = [p for p in version.parts if p.bucket not in several]
        out = versions.read_buckets(self.spark, self.path, alone, self.schema).drop("bucket")
        if several:
            out = out.unionByName(self._merged([p for p in version.parts if p.bucket in several]))
        return out.drop(*ORDERED)
