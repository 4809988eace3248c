"""Pure Column helpers: no session, no clock, no Python UDF."""
