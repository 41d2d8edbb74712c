"""URL expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import fixed_values as fv
from ledgerloom.functions.binding import let
from ledgerloom.functions.text import empty_to_null, first_non_empty, strip

_URL = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)(.*)$"


def company_profile_url(slug: Column, url: Column) -> Column:
    """Profile page by slug, else the row's own URL, else the directory page."""
    base = fv.COMPANY_PROFILE_BASE
    return F.coalesce(F.concat(F.lit(base + "/"), empty_to_null(slug)), first_non_empty(url), F.lit(base))


def repo_url(text: Column) -> Column:
    """The first code-repository URL in a text without trailing punctuation, else null."""
    found = F.regexp_extract(F.coalesce(text, F.lit("")), f"(?U){fv.REPO_URL_PATTERN}", 0)
    return empty_to_null(F.regexp_replace(found, r"[.,)\"']+$", ""))


def owner_repo(url: Column) -> Column:
    """Struct of owner and repository name, null when the URL is not a repository URL."""
    pattern = f"(?U){fv.OWNER_REPO_PATTERN}"
    repo = F.regexp_replace(F.regexp_extract(url, pattern, 2), r"\.git$", "")
    return F.when(
        url.rlike(pattern), F.struct(F.regexp_extract(url, pattern, 1).alias("owner"), repo.alias("repo"))
    )


def last_path_segment(url: Column) -> Column:
    return F.element_at(F.split(F.regexp_replace(url, "/+$", ""), "/"), -1)


def paper_short_id(entry_id: Column) -> Column:
    """The last path segment without its version suffix."""
    return F.regexp_replace(last_path_segment(entry_id), r"v\d+$", "")


def canonical_url(url: Column) -> Column:
    """Lower-case scheme and host, drop a default port, and end a bare host with a slash."""

    def canonical(text: Column) -> Column:
        scheme = F.lower(F.regexp_extract(text, _URL, 1))
        host = F.lower(F.regexp_extract(text, _URL, 2))
        origin = F.regexp_replace(
            F.concat(scheme, F.lit("://"), host), r"^(?:(http://.*):80|(https://.*):443)$", "$1$2"
        )
        rest = F.regexp_extract(text, _URL, 3)
        slash = F.when(rest.startswith("/"), F.lit("")).otherwise(F.lit("/"))
        return F.when(text.rlike(_URL), F.concat(origin, slash, rest)).otherwise(text)

    return let(strip(url), canonical)


def dedup_key(url: Column) -> Column:
    """The canonical URL without scheme, fragment and ``utm_*`` parameters."""
    key = F.regexp_replace(canonical_url(url), r"^[^:/?#]+://", "")
    key = F.regexp_replace(key, r"#.*$", "")
    key = F.regexp_replace(key, r"([?&])utm_[^&]*", "$1")
    key = F.regexp_replace(key, r"&&+", "&")
    key = F.regexp_replace(key, r"\?&+", "?")
    return F.regexp_replace(key, r"[?&]+$", "")


def is_http_url(url: Column) -> Column:
    """True for an absolute http or https URL with a host."""
    return F.coalesce(url, F.lit("")).rlike(r"(?i)^https?://[^\s/?#]+([/?#]\S*)?$")
