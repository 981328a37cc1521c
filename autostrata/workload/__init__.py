"""The engine's operators as named queries over the test tables, with a SQL oracle for each."""
