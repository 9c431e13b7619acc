"""Column expressions: lenient casts and derived business columns.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage code generation.
"""

from kassa.functions.casts import (  # noqa: F401
    lenient_long, lenient_double, lenient_float, lenient_timestamp,
    strip_currency, money,
)
from kassa.functions.derive import (  # noqa: F401
    processing_delay, customer_status, local_stockcode, standard_stockcode,
    final_sale_price, percent_change, archive_region, archive_date, archive_key,
)
