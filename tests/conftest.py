"""One local session for all tests, and small hand-made inputs."""

from __future__ import annotations

import datetime as dt
import json
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from jobtide.schemas import RESPONSES  # noqa: E402
from jobtide.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 8, 8)
    yield session
    session.stop()


START = dt.datetime(2026, 7, 1, 6, tzinfo=dt.UTC)


def response(source, run, key, ordinal, body, status=200, error=None, country=None):
    """A run named by a number is fetched so many hours after the start."""
    text = body if isinstance(body, str) or body is None else json.dumps(body, ensure_ascii=False)
    fetched = START + dt.timedelta(hours=int(run)) if run.isdigit() else START
    return (source, run, str(key), ordinal, f"https://{source}.example/{key}", status, error, text, country, fetched)


def category_job(id, category="Data and Analytics", **more):
    job = {
        "id": id,
        "title": f"Role {id}",
        "company_name": "Acme",
        "category": category,
        "tags": ["python"],
        "candidate_required_location": "Anywhere",
        "salary": "",
        "publication_date": "2026-06-30T08:00:00",
        "url": f"https://jobs.example/{id}",
    }
    return {**job, **more}


def tag_job(id, tags=("dev",), **more):
    job = {
        "id": id,
        "position": f"Role {id}",
        "company": "Acme ",
        "tags": list(tags),
        "location": "",
        "salary_min": "90000",
        "salary_max": "120000",
        "date": "2026-06-30T23:30:00-02:00",
        "url": f"https://jobs.example/{id}",
    }
    return {**job, **more}


def paged_job(id, **more):
    job = {
        "id": id,
        "title": f"Role {id}",
        "company": {"display_name": "Birch"},
        "category": {"label": "IT Jobs"},
        "location": {"display_name": "Leeds"},
        "salary_min": 40000,
        "salary_max": 60000.5,
        "salary_is_predicted": "1",
        "created": "2026-07-01T09:00:00Z",
        "redirect_url": f"https://jobs.example/{id}",
    }
    return {**job, **more}


@pytest.fixture()
def responses(spark):
    """Builds a responses frame from :func:`response` rows."""
    return lambda *rows: spark.createDataFrame(list(rows), RESPONSES)


@pytest.fixture()
def three_sources(responses):
    """A run of each source, one request failing."""
    return responses(
        response("remotive", "1", "data", 0, {"jobs": [category_job(1), category_job(2, salary="$90k", tags=["SQL", " python "])]}),
        response("remotive", "1", "qa", 1, "<html>", 200),
        response("remoteok", "1", "dev", 0, [{"legal": "notice"}, tag_job("11"), tag_job("12", salary_min="0", company="Cedar")]),
        response("adzuna", "1", 1, 0, {"results": [paged_job(21), paged_job(22, company={"display_name": "ACME"})]}, country="gb"),
    )
