"""lapsekit: cross-channel activity, churn and retention as Spark DataFrame operators.

Every public operator takes DataFrames (plus a :class:`~lapsekit.spec.ChurnSpec`)
and returns a lazy DataFrame. Nothing is collected to the driver; Catalyst plans
the joins, aggregates and windows.
"""

from lapsekit.spec import ChurnSpec, Definition, DEFAULT_SPEC

__all__ = ["ChurnSpec", "Definition", "DEFAULT_SPEC"]
