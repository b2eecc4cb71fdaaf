"""Customer-lapse features, labels, training sets, metrics and scores on Spark."""

from lapsewise.config import BuildConfig
from lapsewise.session import spark_session

__all__ = ["BuildConfig", "spark_session"]
