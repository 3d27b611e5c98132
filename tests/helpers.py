"""What several test modules share."""

# Invented items, one text field empty.
ITEM_LINES = [
    "101;2024-03-05 08:15:30.0;4711;55501;9001;CON;0;0;31007;PEP;0;2000-01-01 03:00:00.0;17000000101",
    "102;2024-05-17 19:45:01.0;4712;0;0;;0;1;31008;WWE;0;2000-01-01 03:00:00.0;102",
    "103;2024-05-17 20:00:59.0;4712;5;0;;0;0;31009;PEP;0;2000-01-01 03:00:00.0;103",
]


def with_lost_tasks(rows):
    """The same rows, from tasks that each fail once after their first rows."""

    def lose_first_attempt(batches):
        from pyspark import TaskContext

        for batch in batches:
            yield batch
            if TaskContext.get().attemptNumber() == 0:
                raise RuntimeError("lost")

    return rows.mapInArrow(lose_first_attempt, rows.schema)


def rows_of(df, *columns):
    """The rows as sorted tuples; NULL sorts first."""
    rows = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=lambda row: [(value is not None, str(type(value)), value) for value in row])
