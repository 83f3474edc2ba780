"""menumix: product-mix and menu-engineering analytics as Spark DataFrame functions."""
