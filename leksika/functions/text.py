"""Text functions as column expressions; IDs in comments are those of SURVEY section 2.J and 2.C."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Unicode white space as a regular-expression class that Java and RE2 read alike.
SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
INVISIBLE = r"[\x{200b}\x{200c}\x{200d}\x{feff}]"


def strip_space(c: Column) -> Column:
    """strip Unicode white space from both ends."""
    return F.regexp_replace(c, f"^{SPACE}+|{SPACE}+$", "")


def collapse_space(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, f"{SPACE}+", " "))


def clean_text(c: Column) -> Column:
    """drop invisible characters, collapse white space, strip."""
    return collapse_space(F.regexp_replace(c, INVISIBLE, ""))


def strip_tags(c: Column) -> Column:
    """drop tags, collapse white space, strip."""
    return collapse_space(F.regexp_replace(c, "<[^>]+>", ""))


def lookup_key(c: Column) -> Column:
    """the form in which words are looked up."""
    return F.lower(strip_space(c))


def without_title_suffix(c: Column) -> Column:
    """what stands before `` - ``, without a trailing number."""
    return F.regexp_replace(F.element_at(F.split(c, " - "), 1), f"{SPACE}+\\d+$", "")


def without_numbering(c: Column) -> Column:
    """without a leading ``1. `` or ``2) ``."""
    return F.regexp_replace(c, r"^\s*\d+[\.\)]\s*", "")


def before_example(c: Column) -> Column:
    """what stands before ``contoh:``."""
    return F.trim(F.element_at(F.split(c, r"(?i)contoh\s*:"), 1))


def without_example_label(c: Column) -> Column:
    """without a leading ``contoh:``."""
    return F.regexp_replace(c, r"(?i)^contoh\s*:\s*", "")


def list_items(c: Column, separators: str = "[,;]") -> Column:
    """Split, clean, without trailing ``.;:``, distinct in order of first occurrence."""
    parts = F.transform(F.split(c, separators), lambda x: F.trim(F.regexp_replace(clean_text(x), "[.;:]+$", "")))
    return F.array_distinct(F.filter(parts, lambda x: x != ""))


def ordered_distinct(items: Column) -> Column:
    """Stripped, not empty, distinct in order of first occurrence."""
    return F.array_distinct(F.filter(F.transform(items, strip_space), lambda x: x != ""))


def capitalised(c: Column) -> Column:
    """first letter upper-cased if no letter is upper case and some letter is lower case."""
    return F.when((c == F.lower(c)) & (c != F.upper(c)), F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, 2, 1 << 30))).otherwise(c)


def slug(c: Column) -> Column:
    """Lower case, white space to hyphens, only a-z, 0-9, hyphen and underscore; the lowered word if nothing is left."""
    lowered = F.lower(strip_space(c))
    bare = F.regexp_replace(F.regexp_replace(lowered, f"{SPACE}+", "-"), r"[^a-z0-9\-_]", "")
    return F.coalesce(F.nullif(bare, F.lit("")), lowered)


def file_slug(c: Column) -> Column:
    """safe for a file name."""
    return F.substring(F.regexp_replace(F.lower(strip_space(c)), r"[^a-z0-9._-]+", "-"), 1, 120)


def url_of(base: str, word: Column) -> Column:
    """A word's page under ``base``; spaces as %20."""
    return F.concat(F.lit(base.rstrip("/") + "/"), F.replace(F.url_encode(strip_space(word)), F.lit("+"), F.lit("%20")))


def url_key(url: Column) -> Column:
    """the last path segment, unquoted, lower case; null unless http(s) with a host and no credentials."""
    plain = url.rlike(r"^https?://[^/?#@]+(?:[/?#]|$)")
    path = F.regexp_replace(F.regexp_extract(url, r"^https?://[^/?#]*([^?#]*)", 1), "/+$", "")
    last = F.substring_index(path, "/", -1)
    return F.when(plain & (last != ""), F.lower(F.try_url_decode(F.replace(last, F.lit("+"), F.lit("%2B")))))


def url_host(url: Column) -> Column:
    """lower-cased host."""
    return F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]*)", 1))


def truncated(c: Column, size: int = 6000) -> Column:
    """The first characters, without white space at their end."""
    return F.regexp_replace(F.substring(c, 1, size), f"{SPACE}+$", "")


# Parts of keys whose values are secret.
SECRET = "(?i)(password|passwd|secret|token|api[_-]?key|credential|authorization|cookie|session|private[_-]?key)"


def redacted(m: Column, pattern: str = SECRET) -> Column:
    """a map with the values of keys that look like secrets masked."""
    return F.transform_values(m, lambda k, v: F.when(k.rlike(pattern), "[REDACTED]").otherwise(v))


def durable_int(c: Column) -> Column:
    """text of a whole number as a number, else null."""
    return F.when(c.rlike(r"^-?\d+$"), F.try_to_number(c, F.lit("S999999999999999999")).cast("long"))


def iso_z(ts: Column) -> Column:
    """ISO-8601 in UTC with Z; a fraction of six digits only if it isn't zero."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    micros = F.unix_micros(ts.cast("timestamp")) % 1_000_000
    return F.concat(whole, F.when(micros != 0, F.concat(F.lit("."), F.lpad(micros.cast("string"), 6, "0"))).otherwise(""), F.lit("Z"))


def iso_now() -> Column:
    """The time of the query, as ``iso_z`` writes it."""
    return iso_z(F.current_timestamp())


def release_tag(ts: Column, number: int = 1) -> Column:
    """``2024-05-01.1``."""
    return F.concat(F.date_format(ts, "yyyy-MM-dd"), F.lit(f".{number}"))


def retry_after(value: Column, now: Column) -> Column:
    """seconds to wait by a Retry-After header: seconds, or an HTTP date; null if invalid or negative, 0 if past."""
    seconds = F.when(value.rlike(r"^\s*\d+(\.\d+)?\s*$"), F.trim(value).cast("double"))
    at = F.try_to_timestamp(F.regexp_replace(F.trim(value), "^[A-Za-z]{3}, ", ""), F.lit("dd MMM yyyy HH:mm:ss zzz"))
    return F.coalesce(seconds, F.when(at.isNotNull(), F.greatest(F.lit(0.0), (F.unix_micros(at.cast("timestamp")) - F.unix_micros(now.cast("timestamp"))) / 1e6)))


def backoff(attempt: Column, base: float = 0.5, most: float = 8.0, jitter: Column | None = None) -> Column:
    """seconds before a retry; ``jitter`` from 0 to 1 (``F.rand(seed)``, say) adds up to a tenth."""
    wait = F.least(F.lit(base) * F.pow(F.lit(2.0), attempt), F.lit(most))
    return wait if jitter is None else wait * (1 + 0.1 * jitter)


def details(c: Column, size: int = 500) -> Column:
    """the beginning of a value's JSON, for messages."""
    return F.substring(F.to_json(F.struct(c.alias("value"))), 1, size)


def status_class(status: Column) -> Column:
    """Success, transient (429, 5xx, 0), permanent."""
    return F.when((status == 0) | (status == 429) | status.between(500, 599), "transient").when(status >= 400, "permanent").otherwise("success")


def next_generation(c: Column) -> Column:
    """``gen-7`` to ``gen-8``; ``gen-1`` for anything else."""
    return F.concat(F.lit("gen-"), F.coalesce(F.regexp_extract(c, r"^gen-(\d+)$", 1).try_cast("int") + 1, F.lit(1)).cast("string"))
