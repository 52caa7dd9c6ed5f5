"""tablewise: DataFrame-in / DataFrame-out data-quality, preparation, association
and mining operators, expressed as Spark plans."""

from tablewise.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
