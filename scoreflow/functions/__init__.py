from scoreflow.functions.quantiles import exact_quantiles, mode_of  # noqa: F401
from scoreflow.functions import scalars  # noqa: F401
