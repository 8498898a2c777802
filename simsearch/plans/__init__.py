"""Join strategies, distributed selection and shared storage."""
