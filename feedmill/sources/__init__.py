"""Where ops come from and where the change log is kept."""
