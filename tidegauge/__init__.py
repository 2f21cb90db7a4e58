"""Web-traffic and app-usage metrics as Spark DataFrame transformations."""
