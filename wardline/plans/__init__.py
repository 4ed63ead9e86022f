"""Named report queries over the driver's tables (flows E1-E4 of the blueprint)."""

from wardline.plans.registry import ORACLE, QUERIES  # noqa: F401
from wardline.plans import grid_queries  # noqa: F401
from wardline.plans import explore_queries  # noqa: F401,E402
from wardline.plans import tuple_queries  # noqa: F401,E402
from wardline.plans import metric_queries  # noqa: F401,E402
from wardline.plans import text_queries  # noqa: F401,E402
from wardline.plans import series_queries  # noqa: F401,E402
from wardline.plans import model_queries  # noqa: F401,E402
from wardline.plans import split_queries  # noqa: F401,E402
