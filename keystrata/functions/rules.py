"""Rule expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def health_v1(status: Column, failed: Column, latency_ms: Column, timeout_ms: int = 2_000) -> Column:
    """alive only at 200; 401, errors and timeouts are dead; other codes leave null (unchanged)."""
    return F.when(failed | (latency_ms > timeout_ms), "dead").when(status == 200, "alive").when(status == 401, "dead")


def health_v2(status: Column, failed: Column) -> Column:
    """alive at any 2xx; 401 and errors are dead; other codes leave null; no timeout."""
    return F.when(failed, "dead").when(status.between(200, 299), "alive").when(status == 401, "dead")


def coalesce_chain(argument: Column, given: Column, environment: Column, hook: Callable[[Column], Column] | None = None) -> Column:
    """The first of the three that isn't null; with a hook in their place, what it makes of the environment's.

    A hook is applied last and its null stands: it rejects the row (filter on it).
    """
    return F.coalesce(argument, given, environment) if hook is None else hook(environment)


def first_true_code(flags: list[Column], first: int = 150) -> Column:
    """The code of the first true flag, 0 if none; null counts as false."""
    out = F.when(F.coalesce(flags[0], F.lit(False)), first)
    for i, flag in enumerate(flags[1:], 1):
        out = out.when(F.coalesce(flag, F.lit(False)), first + i)
    return out.otherwise(0)


def reject_reason(prerendered: Column, framed: Column, local_host: Column, local_file: Column, disabled: Column, allow_frame: Column, allow_local: Column) -> Column:
    """First reason not to count a hit; null means count it. Two switches lift two of the rules; a null flag or switch is off."""
    on = lambda flag: F.coalesce(flag, F.lit(False))
    no_frame, no_local = ~on(allow_frame), ~on(allow_local)
    return F.when(on(prerendered), "prerender").when(on(framed) & no_frame, "frame").when(on(local_host) & no_local, "localhost").when(on(local_file) & no_local, "localfile").when(on(disabled), "disabled")


def truthy(token: Column) -> Column:
    """1, t or true in any case; null is false."""
    return F.coalesce(F.lower(token).isin("1", "t", "true"), F.lit(False))


def allowlist(json_text: Column, allowed: list[str]) -> Column:
    """Map of the allowed keys of a JSON object; null for text that isn't one."""
    return F.map_filter(F.from_json(json_text, "map<string,string>"), lambda k, _: k.isin(*allowed))


def dispatch(kind: Column, tags: dict[str, str]) -> Column:
    """Tag of a kind, null (to be rejected) if unknown."""
    pairs = [F.lit(x) for kv in tags.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), kind)


def _percent(share: Column) -> Column:
    """Rounded, halves up; null stays null."""
    return F.floor(share + 0.5).cast("int")


def _share(elapsed: Column, duration: float) -> Column:
    share = elapsed / duration * 100
    return F.when(share.isNotNull(), F.least(share, F.lit(100.0)))


def progress(elapsed: Column, duration: float) -> Column:
    """Integer percent done, at most 100."""
    return _percent(_share(elapsed, duration))


def remaining(elapsed: Column, duration: float) -> Column:
    """Integer percent left, 0 at least: what is left is rounded, not what is done."""
    return _percent(100 - _share(elapsed, duration))
