from scoreflow.sources.tables import read_table, subjects, SUBJECTS_SQL  # noqa: F401
