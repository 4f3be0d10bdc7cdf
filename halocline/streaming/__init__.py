"""New periods arriving as files."""
