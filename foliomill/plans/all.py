"""All plans: importing this registers every query."""

from . import answers, audits, catalogue, publishing, retrieval, shown, structure, texts  # noqa: F401
from .registry import QUERIES, SQL  # noqa: F401
