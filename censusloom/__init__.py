"""Small-area population estimates as Spark jobs over weighted census microdata."""
