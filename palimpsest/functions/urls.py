"""URL allow-list."""

from __future__ import annotations

from pyspark.sql import Column

from palimpsest.functions.expr import apply_sql, sql_text


_HOST = r"^(?iu)https?://([^/:?#]+)"


def host_sql(url: str) -> str:
    return f"rtrim('.', lower(regexp_extract({url}, {sql_text(_HOST)}, 1)))"


def allowed_sql(url: str, domains) -> str:
    """SQL: the host of ``url`` is one of the domains or lies below one."""
    if not domains:
        return "false"
    exact = ", ".join(sql_text(d) for d in domains)
    below = " OR ".join(f"endswith(h, {sql_text('.' + d)})" for d in domains)
    return f"transform(array({host_sql(url)}), h -> h IN ({exact}) OR {below})[0]"


def url_host(url: Column) -> Column:
    """Lower-cased host of an http(s) URL without trailing dots; '' if there is none."""
    return apply_sql(url, f"u -> {host_sql('u')}")


def url_allowed(url: Column, domains) -> Column:
    """The host is one of the domains or lies below one."""
    return apply_sql(url, f"u -> {allowed_sql('u', list(domains))}")
