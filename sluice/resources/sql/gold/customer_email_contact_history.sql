-- CDC source of the type 2 (versioned history) table
SELECT ACCOUNT_ID, EMAIL_ADDRESS, EMAIL_STATUS, PREFERRED_EMAIL_FLAG, UPDATED_AT, processed_time
FROM __silver__.customer_email_contact
