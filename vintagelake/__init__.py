"""vintagelake: monthly credit-portfolio marts as PySpark DataFrame operators.

Every operator is a pure ``DataFrame -> DataFrame`` function built from
built-in Spark expressions; business constants (codes, cut points, labels)
are parameters or rule data in :mod:`vintagelake.functions.ruleset`.
"""

from vintagelake.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
