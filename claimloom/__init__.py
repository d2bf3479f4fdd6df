"""Claims standardisation and combination as Spark DataFrame functions."""

from claimloom.schema import CROSSWALKS, TABLES, CrosswalkSpec, TableSpec
from claimloom.workspace import Workspace

__all__ = ["CROSSWALKS", "TABLES", "CrosswalkSpec", "TableSpec", "Workspace"]
