"""clientlens: customer and purchase analytics as Spark DataFrame operators.

Every public operator takes a DataFrame (plus column roles and parameters) and
returns a DataFrame. Some run jobs while the result is built, and collect one
row or a parameter-sized aggregate each: min/max of a histogram column, means
and standard deviations for scaling, ``describe`` (statistics per column and the
values of the target ranks), k-means centres and the k cluster means. All else
is lazy.
"""

from clientlens.roles import Roles
from clientlens.session import build_session, checkpoint_dir

__all__ = ["Roles", "build_session", "checkpoint_dir"]
