"""Export files, stored tables and the role views over the test tables."""
