"""Column-level building blocks (``Column -> Column``), all JVM-side expressions."""

from wardline.functions.timefmt import elapsed_minutes, hhmm_to_minutes, minutes_to_bin, minutes_to_hhmm  # noqa: F401
from wardline.functions.stats import adjusted_skew, adjusted_kurtosis  # noqa: F401
from wardline.functions.randomness import hash_int, hash_uniform, hash_normal  # noqa: F401
