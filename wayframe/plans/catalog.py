"""All registered queries."""

from wayframe.plans import detection, files, images, labelling, metadata, monitoring, vectors  # noqa: F401
from wayframe.plans.registry import COVERS, QUERIES, TWINS, oracle

__all__ = ["COVERS", "QUERIES", "TWINS", "oracle"]
