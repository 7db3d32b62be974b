"""Job plans (daily batch), the query registry and its SQL oracle."""
