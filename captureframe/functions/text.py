"""Text, keys and JSON of model calls."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

# The key formats that are scrubbed, and the words that mark a quota as used up.
SECRETS = (r"hf_[A-Za-z0-9]{20,}", r"sk-[A-Za-z0-9]{20,}", r"AIza[0-9A-Za-z_-]{30,}")
REDACTED = "[REDACTED_API_KEY]"
QUOTA_WORDS = ("quota", "per day", "free_tier", "daily")


def cache_key(prompt: Column, model: Column, image: Column) -> Column:
    """SHA-256 over prompt, model and image digest."""
    return F.sha2(F.concat(F.coalesce(prompt, F.lit("")), F.lit("|"), F.coalesce(model, F.lit("")), F.lit("|"), F.coalesce(image, F.lit(""))).cast("binary"), 256)


def scrubbed(text: Column) -> Column:
    for pattern in SECRETS:
        text = F.regexp_replace(text, pattern, REDACTED)
    return text


def without_fences(text: Column) -> Column:
    """A fenced block's inside; other texts trimmed."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(text), r"^```[^\n]*\n", ""), r"\n```[ \t]*$", ""))


def _object(text: str | None) -> str | None:
    """The first balanced {...} of a text, if it parses as an object; braces within strings count as the others do."""
    if not text or "{" not in text:
        return None
    at, depth = text.index("{"), 0
    for end in range(at, len(text)):
        depth += {"{": 1, "}": -1}.get(text[end], 0)
        if not depth:
            try:
                got = json.loads(text[at : end + 1])
            except ValueError:
                return None
            return text[at : end + 1] if isinstance(got, dict) else None
    return None


def first_object(text: Column | str) -> Column:
    """Vectorised balanced scan; only texts that plain parsing rejects need it."""

    @F.pandas_udf("string")
    def scan(texts: pd.Series) -> pd.Series:
        return texts.map(_object)

    return scan(text)


def retry_delay(text: Column, header: Column | None = None) -> Column:
    """Seconds to wait: what the answer's header says, where that is a number; else whole seconds after ``retryDelay``, a colon and perhaps quotes, in any case; else null."""
    named = F.nullif(F.regexp_extract(text, r"""(?i)retryDelay["']?\s*:\s*["']?([0-9]+)""", 1), F.lit("")).try_cast("double")
    return named if header is None else F.coalesce(header.try_cast("double"), named)


def http_status(code: Column, delay: Column, text: Column) -> Column:
    """What an HTTP answer means for the call: ok, quota, retry, unavailable."""
    words = F.lower(text)
    long = F.coalesce(delay > 60, words.contains(QUOTA_WORDS[0]) | words.contains(QUOTA_WORDS[1]) | words.contains(QUOTA_WORDS[2]) | words.contains(QUOTA_WORDS[3]), F.lit(False))
    return F.when(code == 200, "ok").when((code == 429) & long, "quota").when(code == 429, "retry").when(code.isin(400, 401, 403, 404), "unavailable").when(code >= 500, "retry").otherwise("unavailable")
