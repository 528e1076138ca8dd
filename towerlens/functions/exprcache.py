"""Reuse of built Column expressions.

Building a Column costs one JVM round trip per operator, and the geometry
and fixture expressions have thousands of operators, so re-building them
for every query dominates plan construction on small data.  A Column is an
unresolved expression tree that any DataFrame can use, so builders whose
arguments are plain values (column names, numbers) are memoised here; calls
with Column arguments are not cached.  The cache is keyed by the JVM gateway,
so a new gateway starts from scratch.
"""

from __future__ import annotations

from functools import wraps


def cached_expr(fn):
    cache: dict = {}

    @wraps(fn)
    def wrapper(*args, **kw):
        from pyspark import SparkContext

        gw = id(SparkContext._gateway)
        key = (gw, args, tuple(sorted(kw.items())))
        try:
            hit = cache.get(key)
        except TypeError:          # a Column (unhashable) or other non-value argument
            return fn(*args, **kw)
        if hit is None:
            hit = fn(*args, **kw)
            cache[key] = hit
        return hit

    return wrapper


def cached_frame(fn):
    """Memoise a ``fn(spark, sf_dir, ...) -> DataFrame`` builder per session.

    Only the logical plan is kept (no data is cached); the driver's input
    tables are read-only, so a derived table's plan can be shared by every
    query of the session.
    """
    cache: dict = {}

    @wraps(fn)
    def wrapper(spark, *args, **kw):
        key = (id(spark), args, tuple(sorted(kw.items())))
        hit = cache.get(key)
        if hit is None or hit[0] is not spark:
            hit = (spark, fn(spark, *args, **kw))
            cache[key] = hit
        return hit[1]

    return wrapper
