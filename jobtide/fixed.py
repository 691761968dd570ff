"""Names, labels, bounds and message formats that results must match exactly."""

from __future__ import annotations

import datetime as dt

# Source names, in run order.
SOURCES = ("remotive", "remoteok", "adzuna")

# Category slug requested -> display name carried by each posting.
CATEGORY_NAMES = {
    "software-development": "Software Development",
    "artificial-intelligence": "Artificial Intelligence",
    "data": "Data and Analytics",
    "devops": "Devops",
    "qa": "Quality Assurance",
    "information-technology": "Information Technology",
}

# Tags requested, one request each.
REQUEST_TAGS = (
    "dev",
    "engineer",
    "devops",
    "data science",
    "backend",
    "front end",
    "sys admin",
    "testing",
)

# Paging limits of the paged source.
RESULTS_PER_PAGE = 50

# Fixed value: request timeout quoted in the timeout message, in seconds.
TIMEOUT_SECONDS = 30.0

# Formats of the failure messages.
TIMEOUT_MESSAGE = "Timeout after %ss while calling %s"
STATUS_MESSAGE = "%s API returned HTTP %s for %s"
TRANSPORT_MESSAGE = "HTTP request to %s failed: %s"
NOT_JSON_MESSAGE = "%s API returned a non-JSON response from %s"
SHAPE_MESSAGE = "Unexpected shape in %s response: expected %s"
ALL_REQUESTS_FAILED = "All %s failed during the %s extraction: %s"
ALL_SOURCES_FAILED = "All sources failed during the pipeline run: %s"

# Salary confidence labels.
STRUCTURED_USD = "structured_usd"
STRUCTURED_CONVERTED = "structured_converted"
TEXT_ONLY = "text_only"
MISSING = "missing"

# Display labels of the salary confidence.
CONFIDENCE_LABELS = {
    STRUCTURED_USD: "USD as posted",
    STRUCTURED_CONVERTED: "≈ converted (fixed FX rate)",
}
MIXED_CONFIDENCE_LABEL = "not broken down — may include fixed-rate conversions"

# Grain labels of the marts.
SALARY_LEVELS = ("source", "source_salary_source", "source_category")
TIME_LEVELS = ("source", "source_skill")

# Bounds of the time-range checks.
PUBLISHED_AT_FLOOR = dt.datetime(2015, 1, 1, tzinfo=dt.UTC)
INGESTED_AT_FLOOR = dt.datetime(2025, 1, 1, tzinfo=dt.UTC)
CLOCK_SKEW_TOLERANCE = dt.timedelta(minutes=5)
PUBLISHED_AT_FUTURE_TOLERANCE = dt.timedelta(days=1)

# Fixed value: timestamp format of the mart CSV files.
CSV_TIMESTAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'+00:00'"
