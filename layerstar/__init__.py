"""layerstar: a three-layer (bronze / silver / gold) warehouse on PySpark.

Raw CSV extracts are read into declared schemas (bronze), cleansed into typed
tables (silver), joined into a star schema (gold) and analysed.  Every step is a
plain function over DataFrames or Columns, so Catalyst plans the whole chain.
"""

from layerstar.session import get_session, work_root

__all__ = ["get_session", "work_root"]
