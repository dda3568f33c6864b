"""End-to-end marts as pure functions of role DataFrames."""
