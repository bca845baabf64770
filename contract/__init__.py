"""Named queries over the sample tables and the SQL each is checked against."""
