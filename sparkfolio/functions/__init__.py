from sparkfolio.functions.columns import (  # noqa: F401
    as_date,
    as_double,
    as_long,
    changed,
    round_doubles,
    safe_div,
)
