"""A PySpark-native engine for multi-market issuer and security analytics."""
