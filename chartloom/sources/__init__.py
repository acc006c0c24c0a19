"""Where inputs come from and where results go."""
