"""CRM lakehouse on PySpark: landed CRM snapshots to typed tables, edges, history and timeline."""
