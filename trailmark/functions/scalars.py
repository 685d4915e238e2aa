"""Scalar functions on columns: repository names, paths, ids, bins. No Python UDF."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ORIGIN, REVISION, CONTENT = "swh:1:ori:", "swh:1:rev:", "swh:1:cnt:"
HOST = "https://github.com/"


def text(c: Column | str) -> Column:
    """A request column, null taken as ''."""
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def same(a: Column, b: str) -> Column:
    """Whether a equals the column b, in a form that a join doesn't take for a key: sorting by a key that is no column makes it anew in each comparison."""
    return F.array_contains(F.array(b), a)


def trim_unicode(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\A\s+|\s+\z", "")


def canonical_url(repo: Column | str) -> Column:
    """The URL of a repository in any accepted spelling: one host prefix and one .git suffix are taken off, case stays."""
    given = text(repo)
    c = F.regexp_replace(trim_unicode(given), r"\A/+|/+\z", "")
    for pattern in (r"\Ahttps://github\.com/", r"\Agithub\.com/", r"\.git\z"):
        c = F.regexp_replace(c, pattern, "")
    # Where both ends are visible ASCII and no slash, nothing is trimmed and no pattern is needed. A prefix ends with a slash, so .git lies behind it.
    host = F.when(given.startswith(HOST), len(HOST)).otherwise(0)
    start = host + F.when(F.substring(given, host + 1, len("github.com/")) == "github.com/", len("github.com/")).otherwise(0)
    bare = F.substring(given, start + 1, F.char_length(given) - start - F.when(given.endswith(".git"), 4).otherwise(0))
    ends = [F.ascii(F.substring(given, at, 1)) for at in (1, -1)]
    plain = [e.between(33, 126) & (e != ord("/")) for e in ends]
    return F.concat(F.lit(HOST), F.when(plain[0] & plain[1], bare).otherwise(c))


def origin_swhid(url: Column | str) -> Column:
    return F.concat(F.lit(ORIGIN), F.sha1(F.col(url) if isinstance(url, str) else url))


def normalize_path(path: Column | str) -> Column:
    """Without white space around, leading ./ and then leading /; backslashes become slashes after that."""
    return F.translate(F.regexp_replace(trim_unicode(text(path)), r"\A(?:\./)*/*", ""), "\\", "/")


def path_components(path: Column | str) -> Column:
    """Non-empty parts of the normalised path, as bytes; . and .. are ordinary names."""
    return F.transform(F.filter(F.split(normalize_path(path), "/", -1), lambda x: x != ""), lambda x: x.cast("binary"))


def revision_swhid(id_: Column | str) -> Column:
    c = text(id_)
    return F.when(c.startswith(REVISION), c).otherwise(F.concat(F.lit(REVISION), c))


def qualified_id(content: Column, origin: Column, visit: Column, revision: Column, path: Column) -> Column:
    return F.concat(content, F.lit(";origin="), origin, F.lit(";visit="), visit, F.lit(";anchor="), revision, F.lit(";path=/"), normalize_path(path))


def hash_prefix(swhid: Column | str, nibbles: int) -> Column:
    """The first nibbles (40 at most) hex digits of a SWHID's hash."""
    c = F.col(swhid) if isinstance(swhid, str) else swhid
    return F.substring(c, len(REVISION) + 1, min(nibbles, 40)) if nibbles else F.lit("")


def packed(swhid: Column | str) -> tuple[Column, Column]:
    """A revision's SWHID as (hash, text): 20 bytes in place of 50 characters that no codec of a shuffle makes smaller; text where its digits, in lower case, don't give it back."""
    c = F.col(swhid) if isinstance(swhid, str) else swhid
    hash_ = F.unhex(F.substring(c, len(REVISION) + 1, 40))
    exact = F.coalesce(F.concat(F.lit(REVISION), F.lower(F.hex(hash_))) == c, F.lit(False))
    return F.when(exact, hash_), F.when(~exact, c)


def unpacked(hash_: Column | str, text_: Column | str) -> Column:
    return F.coalesce(F.concat(F.lit(REVISION), F.lower(F.hex(hash_))), text_)


def commit_key(commit: Column | str, nibbles: int) -> Column:
    """The lookup key of a commit id: its first nibbles characters in lower case; null unless hex."""
    key = F.lower(F.substring(text(commit), 1, nibbles)) if nibbles else F.lit("")
    return F.when(key.rlike(r"\A[0-9a-f]*\z"), key)


def all_full_hashes(commit: Column | str) -> Column:
    """Aggregate: whether there are rows and every commit id is 40 hex digits."""
    return F.coalesce(F.bool_and(text(commit).rlike(r"\A[0-9a-fA-F]{40}\z")), F.lit(False))


def parse_bin(c: Column | str) -> Column:
    """An unsigned 16-bit number in text, else 0."""
    t = trim_unicode(text(c))
    digits = F.regexp_replace(t, r"\A\+?0*(?=[0-9])", "")
    n = F.when(t.rlike(r"\A\+?[0-9]+\z") & (F.length(digits) <= 5), digits.try_cast("int"))
    return F.when(n <= 65535, n).otherwise(F.lit(0))


def output_status(status: Column | str) -> Column:
    """ok, or path_not_found for every finer status."""
    return F.when((F.col(status) if isinstance(status, str) else status) == "ok", F.lit("ok")).otherwise(F.lit("path_not_found"))
