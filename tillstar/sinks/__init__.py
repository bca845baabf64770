"""Writers: layer tables, dated export files, comments."""
