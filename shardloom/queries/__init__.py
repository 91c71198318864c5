"""Kernel queries over the test tables, each with the SQL it is held against."""

from . import annotations, flagship, images, planning, relational  # noqa: F401
from .base import QUERIES, SQL  # noqa: F401
