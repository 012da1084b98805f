"""Plans as text, for tests that look at them."""


def plan_text(df) -> str:
    """Executed plan; for an adaptive plan that already ran, the final plan only."""
    text = df._jdf.queryExecution().executedPlan().toString()
    if "== Final Plan ==" in text:
        text = text.split("== Final Plan ==", 1)[1].split("== Initial Plan ==", 1)[0]
    return text
