from satlake.service import main

main()
