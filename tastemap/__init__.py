"""tastemap: collaborative-filtering analytics written as Spark plans.

Every public function takes and returns DataFrames; nothing of data size
passes through the driver.  Column names are parameters with the defaults
``user_id``, ``item_id``, ``rating`` and ``ts``.
"""

from tastemap.session import build_session, checkpoint_dir, scratch_path

__all__ = ["build_session", "checkpoint_dir", "scratch_path"]
