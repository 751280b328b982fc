"""millrace: typed readers, relational operators, features, models and streams on PySpark."""
