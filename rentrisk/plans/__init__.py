"""The four flows of the application as DataFrame -> DataFrame functions."""
