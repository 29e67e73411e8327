"""Reading trips and tables, writing results, staging shared intermediate tables."""
