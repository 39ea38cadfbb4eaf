"""Training-data operators for very large corpora. Nothing outside this package imports it.

Functions are shipped to executors by value (see ``_register``), so a cluster needs only the
driver to have this package.
"""

from . import _register  # noqa: F401
