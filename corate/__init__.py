"""corate: collaborative filtering and similar-item search as Spark DataFrame operators.

Every public function takes DataFrames and returns DataFrames; nothing data-sized
is collected on the driver. Some write intermediate tables while the plan is
built (``corate.session.materialize``). Sub-packages:

* ``sources``   -- CSV readers/writers and fixtures derived from the test tables
* ``functions`` -- column expressions (hash family, co-rating similarity)
* ``operators`` -- dense index, MinHash/LSH, Jaccard, neighbours, predictions, ALS, metrics
* ``plans``     -- end-to-end compositions (similar pairs, recommend)
"""

from corate.session import build_session, ensure_checkpoint_dir

__all__ = ["build_session", "ensure_checkpoint_dir"]
