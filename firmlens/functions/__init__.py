from firmlens.functions.columns import (  # noqa: F401
    add_one_month_text,
    argmax_class,
    as_default_flag,
    blank_to_null,
    date_from_ints,
    event_description,
    month_of,
    padded_date_text,
    subtract_one_month_text,
)
