"""Row-set operators: ``DataFrame -> DataFrame``."""
