from voltcube.sources.tables import TABLES, TableSource  # noqa: F401
