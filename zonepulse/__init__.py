"""Urban-mobility analytics on PySpark: trips → zone-hour grid → features, models, serving."""
