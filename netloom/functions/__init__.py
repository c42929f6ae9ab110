"""Column expressions and small reusable building blocks."""

from netloom.functions.columns import (  # noqa: F401
    caption,
    html_escape,
    name_of,
    pop_corr,
    safe_div,
)
from netloom.functions.prefix import running_total  # noqa: F401
