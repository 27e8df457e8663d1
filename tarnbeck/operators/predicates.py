"""Predicates: compilers from filter values, globs and search strings to columns."""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column
from pyspark.sql import functions as F


def contains_text(query: str, *columns: str) -> Column:
    """Case-insensitive LIKE %query% over any of the columns; % and _ in the query stay wildcards."""
    test = F.lit(False)
    for c in columns:
        test = test | F.coalesce(F.col(c).ilike(f"%{query}%"), F.lit(False))
    return test


def loose_text(query: str, column: str) -> Column:
    """As contains_text, with hyphens and spaces left out on both sides."""
    bare = F.regexp_replace(column, "[- ]", "")
    return bare.ilike("%" + re.sub("[- ]", "", query) + "%")


def glob_pattern(glob: str) -> str | None:
    """A LIKE pattern with backslash escapes; None for the bare *, which filters nothing."""
    if glob == "*":
        return None
    return "".join({"*": "%", "?": "_", "%": "\\%", "_": "\\_", "\\": "\\\\"}.get(c, c) for c in glob)


def glob_match(glob: str, column: str) -> Column:
    pattern = glob_pattern(glob)
    return F.lit(True) if pattern is None else F.col(column).ilike(pattern)


def roles(wanted: list[str], column: str) -> Column:
    """In the list; names that ! begins are excluded instead."""
    yes, no = [r for r in wanted if r[:1] != "!"], [r[1:] for r in wanted if r[:1] == "!"]
    test = F.col(column).isin(yes) if yes else F.lit(True)
    return test & ~F.col(column).isin(no) if no else test


def has_tags(tags: list[str], column: str) -> Column:
    """All tags in the array; ["none"] asks for an empty or absent one."""
    if tags == ["none"]:
        return F.col(column).isNull() | (F.size(column) == 0)
    test = F.lit(True)
    for t in tags:
        test = test & F.array_contains(F.col(column), t)
    return test


def any_message(query: str, messages: str, title: str) -> Column:
    """A message's lower-cased content holds the query, or the title is like it."""
    return F.exists(F.col(messages), lambda m: F.contains(F.lower(m["content"]), F.lit(query.lower()))) | F.col(title).ilike(f"%{query}%")


@dataclass
class Search:
    text: str = ""
    tags: list[str] = field(default_factory=list)
    folders: list[str] = field(default_factory=list)
    pinned: bool | None = None
    archived: bool | None = None
    shared: bool | None = None


def parse_search(query: str) -> Search:
    """tag:, folder:, pinned:, archived: and shared: tokens leave the query; tags get _ for spaces' sake as they are."""
    found = Search()
    words = []
    for token in query.strip().lower().split():
        key, _, value = token.partition(":")
        if key == "tag" and value:
            found.tags.append(value.replace(" ", "_"))
        elif key == "folder" and value:
            found.folders.append(value)
        elif key in ("pinned", "archived", "shared") and value in ("true", "false"):
            setattr(found, key, value == "true")
        else:
            words.append(token)
    found.text = " ".join(words)
    return found


def compile_search(search: Search, text: str, tags: str, folder: str, pinned: str, archived: str, shared: str) -> Column:
    test = F.col(text).ilike(f"%{search.text}%") if search.text else F.lit(True)
    if search.tags:
        test = test & has_tags(search.tags, tags)
    if search.folders:
        test = test & F.col(folder).isin(search.folders)
    for want, column in ((search.pinned, pinned), (search.archived, archived)):
        if want is not None:
            test = test & (F.coalesce(F.col(column), F.lit(False)) == want)
    if search.shared is not None:
        test = test & (F.col(shared).isNotNull() == search.shared)
    return test


def metadata_filter(spec: dict, get) -> Column:
    """Equality of stringified values, $in ([] is false), $eq $ne $nin $exists, nested $and and $or. get(key) is a column."""
    test = F.lit(True)
    for key, value in spec.items():
        if key in ("$and", "$or"):
            parts = [metadata_filter(x, get) for x in value]
            one = F.lit(key == "$and")
            for p in parts:
                one = one & p if key == "$and" else one | p
        elif isinstance(value, dict):
            one = F.lit(True)
            for op, v in value.items():
                if op == "$in":
                    part = get(key).isin([str(x) for x in v]) if v else F.lit(False)
                elif op == "$nin":
                    part = ~F.coalesce(get(key).isin([str(x) for x in v]), F.lit(False)) if v else F.lit(True)
                elif op == "$eq":
                    part = get(key) == str(v)
                elif op == "$ne":
                    part = ~get(key).eqNullSafe(F.lit(str(v)))
                elif op == "$exists":
                    part = get(key).isNotNull() if v else get(key).isNull()
                else:
                    raise ValueError(f"unknown operator {op}")
                one = one & part
        else:
            one = get(key) == str(value)
        test = test & one
    return test


def host_allowed(rules: list[str], host: Column) -> Column:
    """Host suffixes; those with ! block and win; no allowing rule allows all."""
    allow, block = [r for r in rules if r[:1] != "!"], [r[1:] for r in rules if r[:1] == "!"]
    ends = lambda suffix: (host == suffix) | host.endswith("." + suffix)
    test = F.lit(not allow)
    for r in allow:
        test = test | ends(r)
    for r in block:
        test = test & ~ends(r)
    return F.coalesce(test, F.lit(False))


def url_allowed(rules: list[str], url: str) -> Column:
    """A URL with a host that the rules allow; names are not resolved."""
    return F.col(url).rlike("^https?://") & host_allowed(rules, F.lower(F.parse_url(F.col(url), F.lit("HOST"))))


def scim_filter(text: str) -> Column | None:
    """userName eq "x" or externalId eq "x"; anything else filters nothing."""
    m = re.fullmatch(r'\s*(userName|externalId)\s+eq\s+"([^"]*)"\s*', text)
    return None if m is None else F.col({"userName": "email", "externalId": "external_id"}[m[1]]) == m[2]


def scim_page(start: int, count: int) -> tuple[int, int]:
    """(offset, limit): start from 1, 0 to 100 rows."""
    return max(start, 1) - 1, min(max(count, 0), 100)


def active_now(column: str, now: int, within: int = 180) -> Column:
    return F.col(column) >= now - within


def active_today(column: str, now: int) -> Column:
    return F.col(column) > now // 86400 * 86400


def unread(last_read: int, me) -> Column:
    """Top-level, newer than last read, of others."""
    return F.col("parent_id").isNull() & (F.col("created_at") > last_read) & (F.col("user_id") != me)


def folder_key(column: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(column, r"[\s_]+", " ")))


def not_empty_sample(prompt: str, answer: str) -> Column:
    return (F.size(prompt) > 0) & (F.regexp_replace(answer, r"^\s+|\s+$", "") != "")
