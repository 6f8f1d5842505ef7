"""Customer-behaviour analytics on Spark: marts, features, change streams, alerts."""
