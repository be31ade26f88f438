"""Customer-service analytics on PySpark: change events -> current-state tables -> star schema -> KPIs."""
