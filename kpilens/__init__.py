"""kpilens: retail KPI and change-explanation operators on Spark DataFrames.

Every operator is a function from DataFrame(s) to a DataFrame. Nothing is
collected except bounded scalars that have to be validated on the driver
(a month list, a minimum-history check).
"""

from kpilens.config import Rules, DEFAULT_RULES  # noqa: F401
from kpilens.session import get_spark  # noqa: F401
