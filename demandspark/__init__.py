"""demandspark — spatio-temporal demand analysis and forecasting as lazy Spark DataFrame operators.

Layout:
    sources/    readers, the ``events`` → panel binding, submission sink and output contract
    functions/  pure ``Column`` builders (time, space, category, numeric, metrics)
    operators/  frame-in / frame-out operators (profiling, features, encodings, lags, CV, ensemble, errors)
    plans/      assembled feature plans and the query catalog checked against DuckDB
    streaming/  the same scoring-time features applied to a Structured Streaming source
"""

from demandspark.session import ensure_checkpoint_dir, get_session

__all__ = ["ensure_checkpoint_dir", "get_session"]
