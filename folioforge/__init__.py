"""Text reconciliation and document quality as DataFrame functions."""
