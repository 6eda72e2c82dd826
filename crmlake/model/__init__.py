from crmlake.model.tables import KEYS, PARTITIONS, TABLES, columns, lengths, required, schema

__all__ = ["KEYS", "PARTITIONS", "TABLES", "columns", "lengths", "required", "schema"]
