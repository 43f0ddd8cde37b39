import contextlib
import io


def plan_text(df, mode: str = "formatted") -> str:
    """The physical plan as text (what ``explain`` prints)."""
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain(mode)
    return buf.getvalue()


def executed_plan(df) -> str:
    """The final adaptive plan: what ``explain`` prints after the query has run."""
    df.collect()
    return plan_text(df, "simple")
