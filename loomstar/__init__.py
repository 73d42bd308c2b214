"""loomstar: a Spark-native retail star-schema engine.

Sources bring dirty retail data in as all-string DataFrames, cleaning operators
repair it as pure ``DataFrame -> DataFrame`` transforms, ``conform`` fixes the
schema, constraint jobs check keys, and the analytic plans answer business
questions over the star.  Every step is a lazy Spark plan built from built-in
expressions; nothing is collected to the driver in the middle.
"""

from loomstar.session import get_session, scratch_path

__all__ = ["get_session", "scratch_path"]
