"""Social post analytics on Spark: contact closeness, post impact, topic words."""
