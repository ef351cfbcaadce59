"""Registered queries, each with the SQL that must give the same rows."""

from lumenframe.catalog import checks, files, images, reports, runs, scoring, tables, text
from lumenframe.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES", "files", "images", "reports", "runs", "scoring", "tables", "text"]
