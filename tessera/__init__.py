"""tessera: a library of Spark DataFrame operators and named batch / streaming jobs.

Every operator is a plain function ``DataFrame -> DataFrame`` built from column
expressions, joins, aggregates and windows, so Catalyst plans it and adaptive
query execution (AQE) re-plans it at run time. IO lives at the edges
(``tessera.sources`` / ``tessera.sinks``); named end-to-end jobs live in
``tessera.plans``.
"""

from tessera.session import get_session, scratch_root

__all__ = ["get_session", "scratch_root"]
__version__ = "0.1.0"
