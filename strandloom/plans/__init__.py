"""Named queries over the driver tables, with their SQL oracles."""

from . import catalog, files

__all__ = ["catalog", "files"]
