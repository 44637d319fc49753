"""pricelens: PySpark operators for keyed weekly price series."""

from pricelens.config import DEFAULT, Config, Fleet

__all__ = ["DEFAULT", "Config", "Fleet"]
__version__ = "0.1.0"
