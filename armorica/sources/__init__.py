"""Sources: delimited files, workbooks, file trees and database tables."""

from armorica.sources.database import quantile_predicates, read_database, read_database_evenly
from armorica.sources.delimited import read_delimited, separator_for
from armorica.sources.tree import FileTree, SourceFile, file_tree, list_files, list_one_level, read_file, read_groups
from armorica.sources.workbook import read_workbooks

__all__ = [
    "FileTree",
    "SourceFile",
    "file_tree",
    "list_files",
    "list_one_level",
    "quantile_predicates",
    "read_database",
    "read_database_evenly",
    "read_delimited",
    "read_file",
    "read_groups",
    "read_workbooks",
    "separator_for",
]
