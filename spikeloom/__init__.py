"""spikeloom: seeded social-platform tables, their checks and growth reports as Spark jobs.

Every column is a native Spark expression of (seed, tag, key); every table is built from
small per-day count tables by arithmetic, so no step needs a global sort, a driver-side loop
over rows, or a Python worker in the row path.
"""

from spikeloom.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
