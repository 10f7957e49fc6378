"""courtside: a Spark-native star-schema builder for play-by-play sports data.

Dimensions (referee, league, calendar, venue, team, player) and a
game x player fact table whose measures are classified from free-text
play descriptions, all expressed with the PySpark DataFrame API so
Catalyst plans the work.  See README.md for the module map.
"""

from courtside.session import ensure_checkpoint_dir, get_spark

__all__ = ["get_spark", "ensure_checkpoint_dir"]
