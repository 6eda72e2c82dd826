"""Column expressions. Nothing here touches data; everything stays inside Catalyst."""
